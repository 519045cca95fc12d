"""Independent DuckDB SQL for every registered query.

The catalogue relations are re-derived here as CTEs over the raw tables,
written from the mapping rules rather than from the Spark code, and the
tokeniser is written in its split / lower / strip form. These strings are
only run by the correctness check (DuckDB), never by the library.
"""

from __future__ import annotations

# -- relations ---------------------------------------------------------------

_ASIN = "'P' || lpad(CAST({k} AS VARCHAR), 9, '0')"

SELLS = f"""sells AS (
  SELECT CAST(p_partkey AS VARCHAR) AS Id, {_ASIN.format(k='p_partkey')} AS ASIN,
         p_name AS title, p_type AS "group",
         CAST(round((p_retailprice - 900.0) * 10) AS INTEGER) - 1 AS salesrank,
         3 AS categories
  FROM part)"""

SIMILARS = f"""similars AS (
  SELECT Id, ASIN, unnest(sims) AS "similar" FROM (
    SELECT CAST(p_partkey AS VARCHAR) AS Id, {_ASIN.format(k='p_partkey')} AS ASIN,
           list_concat(
             list_slice([{_ASIN.format(k='p_partkey + 37')}, {_ASIN.format(k='p_partkey + 911')},
                         {_ASIN.format(k='p_partkey + 173')}, {_ASIN.format(k='p_partkey + 619')}],
                        1, p_size % 5),
             CASE WHEN p_size % 3 = 0 THEN ['X' || CAST(p_partkey AS VARCHAR)] ELSE [] END) AS sims
    FROM part))"""

CATEGORIES = f"""categories AS (
  SELECT CAST(p_partkey AS VARCHAR) AS Id, {_ASIN.format(k='p_partkey')} AS ASIN, p_type AS category FROM part
  UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), {_ASIN.format(k='p_partkey')}, p_type || '|' || p_brand FROM part
  UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), {_ASIN.format(k='p_partkey')}, 'size|' || CAST(p_size AS VARCHAR) FROM part)"""

REVIEWS = f"""reviews AS (
  SELECT CAST(l.l_partkey AS VARCHAR) AS Id, {_ASIN.format(k='l.l_partkey')} AS ASIN,
         p.p_type AS "group", CAST(l.l_shipdate AS DATE) AS date,
         CAST(o.o_custkey AS VARCHAR) AS customer,
         1 + CAST(l.l_quantity AS INTEGER) % 5 AS rating,
         CAST(l.l_quantity AS INTEGER) AS votes,
         (CAST(l.l_quantity AS INTEGER) * CAST(round(l.l_discount * 100) AS INTEGER)) // 10 AS helpful
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey)"""


def with_rel(*rels: str) -> str:
    return "WITH " + ",\n".join(rels) + "\n"


# -- word count ----------------------------------------------------------------

TERMS = r"""terms AS (
  SELECT w AS term FROM (
    SELECT regexp_replace(lower(unnest(string_split_regex(text, '[ \t\n\r\f]+'))),
                          '(^[^a-z]+|[^a-z]+$)', '', 'g') AS w
    FROM documents)
  WHERE w <> '')"""

WORDCOUNT = with_rel(TERMS) + "SELECT term, COUNT(*) AS count FROM terms GROUP BY term"
WORDCOUNT_ALPHA = (with_rel(TERMS) + "SELECT term, COUNT(*) AS count FROM terms "
                   "WHERE regexp_full_match(term, '[A-Za-z]+') GROUP BY term")


def _bucket(term: str, n: int = 5) -> str:
    byte = f"('0x' || substr(hex(encode({term})), 2*i+1, 2))::INTEGER"
    h = (f"list_reduce([1::BIGINT] || list_transform(range(octet_length(encode({term}))), "
         f"lambda i: ({byte} - CASE WHEN {byte} >= 128 THEN 256 ELSE 0 END)::BIGINT), "
         f"lambda h, b: (31*h + b) & 4294967295)")
    return f"CAST(({h} & 2147483647) % {n} AS INTEGER)"


def _wc(alpha: bool) -> str:
    return WORDCOUNT_ALPHA if alpha else WORDCOUNT


TERM_BUCKETS = f"SELECT term, count, {_bucket('term')} AS bucket FROM ({WORDCOUNT})"


def _edges(alpha: bool) -> str:
    b = f"SELECT term, count, {_bucket('term')} AS bucket FROM ({_wc(alpha)})"
    return f"""
    WITH b AS ({b}),
    f AS (SELECT bucket, 'first' AS position, CAST(ROW_NUMBER() OVER (PARTITION BY bucket ORDER BY term) AS INTEGER) AS pos, term, count FROM b),
    l AS (SELECT bucket, 'from_last' AS position, CAST(ROW_NUMBER() OVER (PARTITION BY bucket ORDER BY term DESC) AS INTEGER) AS pos, term, count FROM b)
    SELECT * FROM f WHERE pos = 1
    UNION ALL
    SELECT * FROM l WHERE pos = 3"""


UNIQUE_TERMS = f"SELECT COUNT(*) AS unique_terms, COALESCE(SUM(count), 0)::BIGINT AS tokens FROM ({WORDCOUNT})"
UNIQUE_TERMS_ALPHA = f"SELECT COUNT(*) AS unique_terms, COALESCE(SUM(count), 0)::BIGINT AS tokens FROM ({WORDCOUNT_ALPHA})"


# -- catalogue questions -------------------------------------------------------

REVIEW_ID = "6"
SIMILAR_ID = "967"

_REVIEW_ORDER_HIGH = "helpful DESC, rating DESC, date, customer, votes"
_REVIEW_ORDER_LOW = "helpful DESC, rating ASC, date, customer, votes"
_REVIEW_COLS = 'Id, ASIN, "group", date, customer, rating, votes, helpful'

REVIEWS_HIGH = with_rel(REVIEWS) + (
    f"SELECT {_REVIEW_COLS} FROM reviews WHERE Id = '{REVIEW_ID}' ORDER BY {_REVIEW_ORDER_HIGH} LIMIT 5")
REVIEWS_LOW = with_rel(REVIEWS) + (
    f"SELECT {_REVIEW_COLS} FROM reviews WHERE Id = '{REVIEW_ID}' ORDER BY {_REVIEW_ORDER_LOW} LIMIT 5")
REVIEWS_HIGH_ALL = with_rel(REVIEWS) + (
    f"SELECT {_REVIEW_COLS} FROM reviews "
    f"QUALIFY ROW_NUMBER() OVER (PARTITION BY Id ORDER BY {_REVIEW_ORDER_HIGH}) <= 5")
REVIEWS_LOW_ALL = with_rel(REVIEWS) + (
    f"SELECT {_REVIEW_COLS} FROM reviews "
    f"QUALIFY ROW_NUMBER() OVER (PARTITION BY Id ORDER BY {_REVIEW_ORDER_LOW}) <= 5")


def _better(where: str) -> str:
    return with_rel(SELLS, SIMILARS) + f"""
    SELECT s.Id, sim."similar", s.salesrank AS salesrank_original, t.salesrank
    FROM sells s JOIN similars sim ON s.Id = sim.Id JOIN sells t ON sim."similar" = t.ASIN
    WHERE t.salesrank > 0 AND t.salesrank < s.salesrank {where}"""


BETTER_SIMILARS = _better(f"AND s.Id = '{SIMILAR_ID}'")
BETTER_SIMILARS_ALL = _better("")
BETTER_SIMILARS_SQL = BETTER_SIMILARS

SIMILARS_IN_CATALOG = with_rel(SELLS, SIMILARS) + """
    SELECT Id, ASIN, "similar" FROM similars WHERE "similar" IN (SELECT ASIN FROM sells)"""
SIMILARS_DEFAULT_RANK = with_rel(SELLS, SIMILARS) + """
    SELECT sim.Id, sim.ASIN, sim."similar", COALESCE(s.salesrank, -1) AS similar_salesrank
    FROM similars sim LEFT JOIN sells s ON sim."similar" = s.ASIN"""
ID_LOOKUP = with_rel(SELLS, SIMILARS) + """
    SELECT sim.Id, own.ASIN, sim."similar", t.salesrank AS similar_salesrank
    FROM similars sim JOIN sells own ON sim.Id = own.Id JOIN sells t ON sim."similar" = t.ASIN"""

DAILY_RATING = with_rel(REVIEWS) + f"SELECT date, avg(rating) AS avgrating FROM reviews WHERE Id = '{REVIEW_ID}' GROUP BY date"
DAILY_RATING_ALL = with_rel(REVIEWS) + "SELECT date, avg(rating) AS avgrating FROM reviews GROUP BY date"
DAILY_RATING_PARTIALS = with_rel(REVIEWS) + """
    SELECT Id, date, AVG(rating) AS avgrating FROM reviews GROUP BY Id, date"""

_RANKED = 'SELECT "group", Id, title, salesrank FROM sells'
TOP_SELLERS_RANK = with_rel(SELLS) + f"""
    {_RANKED} WHERE salesrank > 0
    QUALIFY RANK() OVER (PARTITION BY "group" ORDER BY salesrank) <= 10"""
TOP_SELLERS_SQL = with_rel(SELLS) + f"""
    {_RANKED} QUALIFY RANK() OVER (PARTITION BY "group" ORDER BY salesrank) < 10"""
TOP_SELLERS_EXACT = with_rel(SELLS) + f"""
    {_RANKED} WHERE salesrank > 0
    QUALIFY ROW_NUMBER() OVER (PARTITION BY "group" ORDER BY salesrank, Id) <= 10"""
TOP_SELLERS_BEST = with_rel(SELLS) + f"""
    {_RANKED} WHERE salesrank > 0
    QUALIFY ROW_NUMBER() OVER (PARTITION BY "group" ORDER BY salesrank, Id) = 1"""


def group_rank_threshold(k: int) -> str:
    return with_rel(SELLS) + f"""
    SELECT "group", MAX(salesrank) AS threshold FROM (
      SELECT "group", salesrank FROM sells WHERE salesrank > 0
      QUALIFY ROW_NUMBER() OVER (PARTITION BY "group" ORDER BY salesrank, Id) <= {k})
    GROUP BY "group" """


GROUP_RANK_THRESHOLD = group_rank_threshold(10)
TOP_SELLERS_THRESHOLD = TOP_SELLERS_RANK
PRODUCT_GROUPS = with_rel(SELLS) + 'SELECT DISTINCT "group" FROM sells'

TOP_HELPFUL = with_rel(SELLS, REVIEWS) + """
    SELECT r.Id, s.ASIN, s.title, r.avghelpful
    FROM (SELECT Id, AVG(helpful) AS avghelpful FROM reviews GROUP BY Id) r JOIN sells s ON r.Id = s.Id
    ORDER BY r.avghelpful DESC, r.Id LIMIT 10"""

TOP_CATEGORIES = with_rel(REVIEWS, CATEGORIES) + """
    SELECT c.category, AVG(r.helpful) AS avghelpful
    FROM reviews r JOIN (SELECT DISTINCT Id, category FROM categories) c ON r.Id = c.Id
    GROUP BY c.category ORDER BY avghelpful DESC, c.category LIMIT 5"""
TOP_CATEGORIES_BY_PRODUCT = with_rel(REVIEWS, CATEGORIES) + """
    SELECT c.category, round(AVG(m.avghelpful), 10) AS avghelpful
    FROM (SELECT Id, AVG(helpful) AS avghelpful FROM reviews GROUP BY Id) m
    JOIN (SELECT DISTINCT Id, category FROM categories) c ON m.Id = c.Id
    GROUP BY c.category ORDER BY avghelpful DESC, c.category LIMIT 5"""

_PER_CUSTOMER = 'SELECT "group", customer, COUNT(*) AS comments FROM reviews GROUP BY "group", customer'
TOP_REVIEWERS = with_rel(REVIEWS) + f"""
    SELECT "group", customer, comments FROM ({_PER_CUSTOMER})
    QUALIFY ROW_NUMBER() OVER (PARTITION BY "group" ORDER BY comments DESC, customer) <= 10"""
TOP_REVIEWERS_TIES = with_rel(REVIEWS) + f"""
    SELECT "group", customer, comments FROM (
      SELECT *, MAX(comments) OVER (PARTITION BY "group") AS max_comments FROM ({_PER_CUSTOMER}))
    WHERE comments = max_comments"""
REVIEWERS_ADDITIVE = with_rel(REVIEWS) + _PER_CUSTOMER
REVIEWERS_DISTINCT = with_rel(REVIEWS) + """
    SELECT "group", customer, products FROM (
      SELECT "group", customer, COUNT(DISTINCT Id) AS products FROM reviews GROUP BY "group", customer)
    QUALIFY ROW_NUMBER() OVER (PARTITION BY "group" ORDER BY products DESC, customer) <= 10"""

LEADERBOARD_SLICE = with_rel(REVIEWS) + """
    SELECT member, score, CAST(position AS INTEGER) AS position FROM (
      SELECT 'P' || lpad(Id, 9, '0') AS member, AVG(helpful) AS score,
             ROW_NUMBER() OVER (ORDER BY AVG(helpful) DESC, 'P' || lpad(Id, 9, '0') DESC) - 1 AS position
      FROM reviews GROUP BY Id)
    WHERE position BETWEEN 0 AND 10"""



def middle_customers(direction: str) -> str:
    return with_rel(REVIEWS) + f"""
    , c AS (SELECT customer, count(*) AS comments FROM reviews GROUP BY customer),
    placed AS (SELECT *, row_number() OVER (ORDER BY comments {direction}, customer {direction}) - 1 AS position FROM c)
    SELECT customer, comments, position FROM placed
    WHERE position BETWEEN (SELECT count(*) // 2 - 5 FROM c) AND (SELECT count(*) // 2 + 5 FROM c)"""


ANY_PRODUCTS = with_rel(SELLS) + "SELECT least(count(*), 10) AS n, least(count(*), 10) AS found FROM sells"

DAILY_NUMERIC_MEANS = with_rel(REVIEWS) + """
    SELECT date, avg(rating) AS avg_rating, avg(votes) AS avg_votes, avg(helpful) AS avg_helpful
    FROM reviews GROUP BY ALL"""
DAILY_RATING_PRINTED = with_rel(REVIEWS) + """
    SELECT date, printf('%.2f', round(avg(rating), 2)) AS avgrating FROM reviews GROUP BY date"""
BEST_SELLERS_REPORT = with_rel(SELLS) + """
    , best AS (SELECT * FROM sells WHERE salesrank > 0 QUALIFY RANK() OVER (PARTITION BY "group" ORDER BY salesrank) <= 10)
    SELECT "group", Id, salesrank, row_number() OVER (ORDER BY "group", salesrank, Id) AS position FROM best"""
DAILY_RATING_REPORT = with_rel(REVIEWS) + """
    SELECT date, avg(rating) AS avgrating, row_number() OVER (ORDER BY date) AS position FROM reviews GROUP BY date"""
CUSTOMER_POSITIONS = with_rel(REVIEWS) + """
    SELECT customer, count(*) AS comments, row_number() OVER (ORDER BY count(*) DESC, customer) AS position
    FROM reviews GROUP BY customer"""
SIMILARS_LOOKED_UP = with_rel(SELLS, SIMILARS) + """
    SELECT m.Id, m."similar", s.salesrank AS similar_salesrank FROM similars m JOIN sells s ON s.ASIN = m."similar" """
PRODUCTS_BY_ASIN = with_rel(SELLS, SIMILARS) + f"""
    SELECT Id, ASIN, title, "group", salesrank FROM sells
    WHERE ASIN IN (SELECT "similar" FROM similars WHERE Id = '{SIMILAR_ID}')"""
TERMS_SORTED = f"SELECT count(*) AS terms, 0::BIGINT AS out_of_order FROM ({WORDCOUNT})"
PARSED_ONCE = with_rel(SELLS, SIMILARS, REVIEWS) + """
    SELECT s.Id, (SELECT count(*) FROM reviews r WHERE r.Id = s.Id) AS n_reviews,
           (SELECT count(*) FROM similars m WHERE m.Id = s.Id) AS n_similars FROM sells s"""

QUESTION_TABLES = {
    "query_table_products": with_rel(SELLS) + 'SELECT Id, ASIN, title, "group", salesrank FROM sells',
    "query_table_similars": with_rel(SELLS, SIMILARS) + """
    SELECT m.Id, m.ASIN, m."similar", s.salesrank, coalesce(t.salesrank, -1) AS similarsales
    FROM similars m JOIN sells s ON s.Id = m.Id LEFT JOIN sells t ON t.ASIN = m."similar" """,
    "query_table_reviews_v1": with_rel(REVIEWS) + "SELECT Id, ASIN, date, customer, rating, votes AS vote, helpful FROM reviews",
    "query_table_reviews_v2": with_rel(REVIEWS) + """
    SELECT Id, ASIN, date, sum(rating)::BIGINT AS total_rating, count(*) AS count_rating FROM reviews GROUP BY ALL""",
    "query_table_groups": with_rel(SELLS) + 'SELECT "group", Id, ASIN, salesrank FROM sells WHERE salesrank > 0',
    "query_table_customer_reviews": with_rel(REVIEWS) + 'SELECT "group", customer, count(*) AS total FROM reviews GROUP BY ALL',
}

# -- catalogue files, sinks, upsert ------------------------------------------

ROUNDTRIP_SELLS = with_rel(SELLS) + "SELECT * FROM sells"
ROUNDTRIP_SIMILARS = with_rel(SIMILARS) + 'SELECT Id, ASIN, "similar" FROM similars'
ROUNDTRIP_REVIEWS = with_rel(REVIEWS) + f"SELECT {_REVIEW_COLS} FROM reviews"
ROUNDTRIP_CATEGORIES = with_rel(CATEGORIES) + "SELECT Id, ASIN, category FROM categories"
ROUNDTRIP_STATS = with_rel(SELLS, REVIEWS) + """
    SELECT s.Id, COALESCE(r.total, 0) AS total, COALESCE(r.total, 0) AS downloaded,
           COALESCE(r.avg_rating, 0.0) AS avg_rating
    FROM sells s LEFT JOIN (
      SELECT Id, CAST(COUNT(*) AS INTEGER) AS total, round(AVG(rating), 1) AS avg_rating
      FROM reviews GROUP BY Id) r ON s.Id = r.Id"""
NESTED_FLATTENED = with_rel(REVIEWS) + """
    SELECT CAST(Id AS INTEGER) AS Id, ASIN, date, customer, rating, votes AS vote, helpful FROM reviews"""
PACKED_REVIEWS = with_rel(REVIEWS) + "SELECT Id, ASIN, date, customer, rating, votes, helpful FROM reviews"

LATEST_BY_KEY = """
    SELECT user_id, event_type, event_id, ts, value, props FROM events
    QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1"""

TOP_SELLERS_FROM_TABLE = with_rel(SELLS) + """
    SELECT "group", Id, ASIN, salesrank FROM sells WHERE salesrank > 0
    QUALIFY ROW_NUMBER() OVER (PARTITION BY "group" ORDER BY salesrank, Id) <= 10"""

TOP_REVIEWERS_LISTS = with_rel(REVIEWS) + f"""
    , kept AS (
      SELECT "group", customer, comments FROM ({_PER_CUSTOMER})
      QUALIFY ROW_NUMBER() OVER (PARTITION BY "group" ORDER BY comments DESC, customer) <= 10)
    SELECT "group",
           string_agg(customer || ':' || CAST(comments AS VARCHAR), ',' ORDER BY comments DESC, customer)
             AS top_customers
    FROM kept GROUP BY "group" """

# Review lines of a record are written in this order by the catalogue
# renderer (see sinks/catalog_text.py); the last one per key wins.
_LINE_ORDER = ("concat_ws('|', strftime(date, '%Y-%m-%d'), customer, lpad(CAST(rating AS VARCHAR), 3, '0'), "
               "lpad(CAST(votes AS VARCHAR), 10, '0'), lpad(CAST(helpful AS VARCHAR), 10, '0'))")
REVIEWS_UPSERTED = with_rel(REVIEWS) + f"""
    SELECT Id, ASIN, date, customer, rating, votes AS vote, helpful FROM reviews
    QUALIFY ROW_NUMBER() OVER (PARTITION BY Id, helpful, rating ORDER BY {_LINE_ORDER} DESC) = 1"""
