"""Source divergence audit: how far each source's words lie from the others'
and from its language's.

Terms are found by a pointer sort. A task gathers about ``SLICE`` bytes of
Arrow text buffers, finds the starts of all words and sorts these pointers by
a multikey quicksort: three-way partitions on one character at a time, the
equal part going on with the next; a character is eight bytes of the word read
at once, and groups under ``LEAF`` pointers are sorted together. Equal runs of
pointers are the terms of the slice. Each run yields, per (language, source),
its occurrences and the documents it occurs in. A task adds its slices up
before anything is shuffled and sends each term's sums to the term's shard, as
one Arrow stream per shard; a shard's task adds the streams up as they come, so
it holds the shard's distinct (language, source, term) and no more. A term that
holds a third of all words is one row per task and group.

Shares are integers: ``p = 1 + floor(10^9 (count + 1) / (N + V))``, computed by
long division in three steps, so no product leaves 64 bits. The divergence of
two sources is summed over all kept terms without a row for every source and
term: what a term adds where both sources lack it is one number per pair of
sources, what it adds where one has it follows from how often each count
occurs in a source, and only terms that both have are looked at in pairs, in
numpy, in blocks, summed in the task. Its rows are (language, source, source),
which is also what is asked for.

Defined results: null text, lang and source are empty strings; a row is a
document, so rows that repeat a doc_id count each. A group without words has
all counts 0. A language with no kept term gives value 0 to its pairs and no
term rows; one with a single source has no pairs. Equal values are ranked by
item. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import bounded_batches, staged, text_bytes, word_spans
from tessera.operators.topk import top_n_per_group

MIN_DOCS = 3
TOP_TERMS = 200
#: Bytes of text whose pointers are sorted together, rows a task adds up
#: before it passes them on, pointers sorted without partitioning, and the
#: most shards that terms are dealt into.
SLICE, COMBINE, LEAF, MAX_SHARDS = 8 << 20, 1 << 20, 4096, 4096
#: Pairs of rows looked at together; sources of a language up to which a task
#: sums pairs in a square table (beyond, by sorting).
PAIRS, SQUARE = 1 << 20, 1024

_codes = np.arange(256)
LOWER = np.where((_codes >= 0x41) & (_codes <= 0x5A), _codes + 32, _codes).astype(np.uint8)
#: Bytes of terms: letters and all of UTF-8's longer forms.
LETTER = ((LOWER >= 0x61) & (LOWER <= 0x7A)) | (_codes >= 0x80)
#: The first n bytes of a character of eight.
FIRST_BYTES = np.array([0] + [(1 << 64) - (1 << (64 - 8 * n)) for n in range(1, 9)], np.uint64)


class Pointers:
    """Words of a lower-cased buffer that has eight zero bytes at its end."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        self.start, self.end, self.last = start, end, len(data) - 8
        self.windows = np.ndarray(len(data) - 7, ">u8", data, strides=(1,))

    def character(self, words: np.ndarray, depth: int) -> np.ndarray:
        """Eight bytes of each word from ``depth`` on, zero beyond its end."""
        at = self.start[words] + depth
        left = np.clip(self.end[words] - at, 0, 8)
        return self.windows[np.minimum(at, self.last)].astype(np.uint64) & FIRST_BYTES[left]


def _partition(order: np.ndarray, char: np.ndarray, lo: int, hi: int) -> None:
    """Sort ``order[lo:hi]`` by its characters ``char[lo:hi]`` in place, by
    three-way partitions; the equal part is done."""
    stack = [(lo, hi)]
    while stack:
        lo, hi = stack.pop()
        part = char[lo:hi]
        if hi - lo <= LEAF:
            take = np.argsort(part)
        else:
            sample = part[::max(1, (hi - lo) // 31)]
            pivot = np.partition(sample, len(sample) // 2)[len(sample) // 2]
            less, more = part < pivot, part > pivot
            take = np.concatenate([np.flatnonzero(less), np.flatnonzero(~(less | more)), np.flatnonzero(more)])
            stack += [(lo, lo + int(less.sum())), (hi - int(more.sum()), hi)]
        order[lo:hi] = order[lo:hi][take]
        char[lo:hi] = part[take]


def sort_pointers(words: Pointers) -> tuple[np.ndarray, np.ndarray]:
    """The words in byte order, and where each run of equal words begins."""
    n = len(words.start)
    order, first = np.arange(n), np.zeros(n, bool)
    at, group, depth = np.arange(n), np.zeros(n, np.int64), 0
    while len(at):
        own = order[at]
        char = words.character(own, depth)
        edges = np.flatnonzero(np.diff(group, prepend=-1, append=-1))
        large = [(a, b) for a, b in zip(edges[:-1], edges[1:]) if b - a > LEAF] if depth == 0 or np.diff(edges).max() > LEAF else []
        small = np.ones(len(at), bool)
        for a, b in large:
            small[a:b] = False
            _partition(own, char, a, b)
        small = np.flatnonzero(small)
        take = small[np.lexsort((char[small], group[small]))]
        own[small], char[small] = own[take], char[take]
        order[at] = own
        new = np.ones(len(at), bool)
        new[1:] = (char[1:] != char[:-1]) | (group[1:] != group[:-1])
        first[at[new]] = True
        run = np.cumsum(new) - 1
        goes_on = ((char & np.uint64(0xFF)) != 0) & (np.bincount(run)[run] > 1)
        at, group, depth = at[goes_on], run[goes_on], depth + 8
    return order, first


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray):
    """The spans of ``data`` as an Arrow string array."""
    import pyarrow as pa

    size = end - start
    ends = np.concatenate([[0], np.cumsum(size)])
    own = data[np.arange(ends[-1]) + np.repeat(start - ends[:-1], size)]
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(own))


def _codes_of(column):
    """Distinct strings of a column, and each row's place among them."""
    import pyarrow as pa

    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    coded = column.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64)


def _table(names, codes, n: np.ndarray, docs: np.ndarray):
    import pyarrow as pa

    columns = [x.take(pa.array(c)) for x, c in zip(names, codes)]
    return pa.table([*columns, pa.array(n, pa.int64()), pa.array(docs, pa.int64())], ["lang", "source", "term", "n", "docs"])


def slice_counts(table):
    """(lang, source, term, n, docs) of the texts of an Arrow table: one
    pointer sort, one row per equal run and group of documents."""
    (langs, lang), (sources, source) = _codes_of(table.column("lang")), _codes_of(table.column("source"))
    wide, docs = max(1, len(sources)), np.int64(max(1, len(lang)))
    kind = lang * wide + source
    by_kind = np.argsort(kind, kind="stable")  # documents of one group get neighbouring numbers
    number = np.empty(len(kind), np.int64)
    number[by_kind] = np.arange(len(kind))
    texts = [text_bytes(c) for c in table.column("text").chunks]
    sizes = np.cumsum([0] + [len(d) for d, _ in texts])
    data = np.concatenate([LOWER[d] for d, _ in texts] + [np.zeros(8, np.uint8)])
    offsets = np.concatenate([o[:-1] + s for (_, o), s in zip(texts, sizes)] + [sizes[-1:]])
    start, end, text = word_spans(data[:-8], offsets, LETTER)
    order, first = sort_pointers(Pointers(data, start, end))
    seen = np.sort((np.cumsum(first) - 1) * docs + number[text[order]])  # (run, document)
    new_doc = np.ones(len(seen), bool)
    new_doc[1:] = seen[1:] != seen[:-1]
    at = np.flatnonzero(new_doc)  # one row per run and document from here on
    run, doc = np.divmod(seen[at], docs)
    group = kind[by_kind][doc]
    new = np.ones(len(at), bool)
    new[1:] = (run[1:] != run[:-1]) | (group[1:] != group[:-1])
    rows = np.flatnonzero(new)
    heads = order[first]
    terms = _strings(data, start[heads], end[heads])
    return _table((langs, sources, terms), (group[rows] // wide, group[rows] % wide, run[rows]),
                  np.diff(np.append(at[rows], len(seen))), np.diff(np.append(rows, len(at))))


class Sums:
    """Rows of equal (lang, source, term) of some tables added up, in the
    order of (lang, term) as numbered by their dictionaries."""

    def __init__(self, tables):
        import pyarrow as pa

        table = pa.concat_tables(tables)
        (self.langs, lang), (self.sources, source), (self.terms, term) = (_codes_of(table.column(c)) for c in ("lang", "source", "term"))
        wide, many = max(1, len(self.sources)), max(1, len(self.terms))
        key = (lang * many + term) * wide + source
        order = np.argsort(key)
        key = key[order]
        rows = np.flatnonzero(np.diff(key, prepend=-1))
        add = lambda c: np.add.reduceat(table.column(c).to_numpy()[order], rows) if len(rows) else rows
        self.n, self.docs = add("n"), add("docs")
        key = key[rows]
        self.pair, self.source = key // wide, key % wide  # pair: lang and term
        self.lang, self.term = self.pair // many, self.pair % many

    def table(self):
        return _table((self.langs, self.sources, self.terms), (self.lang, self.source, self.term), self.n, self.docs)

    def shards(self, shards: int) -> np.ndarray:
        """The shard of each row, by a hash of the bytes of its term."""
        data, offsets = text_bytes(self.terms)
        words = Pointers(np.concatenate([data, np.zeros(8, np.uint8)]), offsets[:-1], offsets[1:])
        spot, live, depth = np.zeros(len(self.terms), np.uint64), np.arange(len(self.terms)), 0
        while len(live):
            mixed = (spot[live] ^ words.character(live, depth)) * np.uint64(0x9E3779B97F4A7C15)
            spot[live] = mixed ^ (mixed >> np.uint64(29))
            depth += 8
            live = live[offsets[live + 1] - offsets[live] > depth]
        return (spot % np.uint64(shards)).astype(np.int64)[self.term]


def _packed(tables, shards: int):
    """(shard, rows): the sums of some tables cut up by shard, each part as
    one Arrow stream."""
    import pyarrow as pa

    sums = Sums(tables)
    shard = sums.shards(shards)
    order = np.argsort(shard, kind="stable")
    table, shard = sums.table().take(pa.array(order)), shard[order]
    cuts = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(shard))
    parts = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table.slice(a, b - a).combine_chunks())
        parts.append(sink.getvalue().to_pybytes())
    yield pa.RecordBatch.from_arrays([pa.array(shard[cuts[:-1]], pa.int32()), pa.array(parts, pa.binary())], ["shard", "rows"])


def _count(batches, shards: int):
    """Sort slice after slice; pass the sums on when they grow large."""
    import pyarrow as pa

    held, size, done = [], 0, []
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= SLICE:
            done.append(slice_counts(pa.Table.from_batches(held)))
            held, size = [], 0
            if sum(t.num_rows for t in done) >= COMBINE:
                yield from _packed(done, shards)
                done = []
    if held:
        done.append(slice_counts(pa.Table.from_batches(held)))
    if done:
        yield from _packed(done, shards)


def _merge(batches, min_docs: int):
    """All sums of one shard: added up as they come, so that a task holds the
    shard's distinct rows and one batch; then terms in too few documents go."""
    import pyarrow as pa

    held, limit = [], COMBINE
    for batch in batches:
        held += [pa.ipc.open_stream(x.as_buffer()).read_all() for x in batch.column("rows")]
        if sum(t.num_rows for t in held) >= limit:
            held = [Sums(held).table()]
            limit = COMBINE + 2 * held[0].num_rows
    if not held:
        return
    sums = Sums(held)
    edges = np.flatnonzero(np.diff(sums.pair, prepend=-1))
    size = np.diff(np.append(edges, len(sums.pair)))
    in_all = lambda x: np.repeat(np.add.reduceat(x, edges), size) if len(edges) else x
    head = np.zeros(len(sums.pair), bool)
    head[edges] = True
    keep = np.flatnonzero(in_all(sums.docs) >= min_docs)
    table = _table((sums.langs, sums.sources, sums.terms), (sums.lang[keep], sums.source[keep], sums.term[keep]), sums.n[keep], in_all(sums.n)[keep])
    yield from table.rename_columns(["lang", "source", "term", "n", "lang_n"]).append_column("head", pa.array(head[keep])).to_batches(65536)


def term_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, term, n, lang_n, head): the occurrences of every kept
    term in every group that has it, and in the language; ``head`` marks one
    row of each (lang, term). All rows of a term come from one task."""
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    shards = min(MAX_SHARDS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), texts.rdd.getNumPartitions()))
    sums = texts.mapInArrow(lambda batches: _count(batches, shards), "shard int, rows binary")
    return (sums.repartitionById(shards, F.col("shard"))
            .mapInArrow(lambda batches: _merge(batches, min_docs), "lang string, source string, term string, n long, lang_n long, head boolean"))


def group_sizes(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, source, total, lang_total, v) of every group of documents."""
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    own = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = counts.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_if("head").alias("v"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return (groups.join(own, ["lang", "source"], "left").join(langs, "lang", "left")
            .select("lang", "source", zero("total"), zero("lang_total"), zero("v")))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def share(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(10^9 (n + 1) / (total + v)), exact; null without terms."""
    d = F.when(v > 0, total + v)
    quotient, rest = _div(n + 1, d), (n + 1) % d
    for _ in range(3):
        quotient, rest = quotient * 1000 + _div(rest * 1000, d), (rest * 1000) % d
    return quotient + 1


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q)."""
    return _div((p - q) * (p - q), q)


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def shared_pairs(batches):
    """For rows (lang, term, source, p, none) in (lang, term) order: summed
    over the terms that two sources of a language both have, what their
    shares add beyond what each alone would (``none``: the share of count 0)."""
    import pyarrow as pa

    lang, place, names, square, rest = None, {}, [], np.zeros((0, 0), np.int64), None

    def rows_of(i, j, value):
        take = lambda k: pa.array(names, pa.string()).take(pa.array(k))
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(i), pa.string()), take(i), take(j), pa.array(value, pa.int64())],
                                          ["lang", "source", "item", "value"])

    def add(term, code, p, none):
        nonlocal square
        edges = np.flatnonzero(np.diff(term, prepend=-1, append=-1))
        size = np.repeat(np.diff(edges), np.diff(edges))
        begin = np.repeat(edges[:-1], np.diff(edges))
        upto = np.cumsum(size)
        a = 0
        while a < len(term):
            b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + PAIRS, side="right")))
            i = np.repeat(np.arange(a, b), size[a:b])
            j = np.arange(len(i)) - np.repeat(upto[a:b] - size[a:b] - (upto[a - 1] if a else 0) - begin[a:b], size[a:b])
            other = i != j
            i, j = i[other], j[other]
            value = _gap(p[i], p[j]) - _gap(p[i], none[j]) - _gap(none[i], p[j]) + _gap(none[i], none[j])
            a = b
            if len(names) <= SQUARE:
                if len(square) < len(names):
                    grown = np.zeros((2 * len(names), 2 * len(names)), np.int64)
                    grown[:len(square), :len(square)] = square
                    square = grown
                np.add.at(square, (code[i], code[j]), value)
            else:
                cell, inverse = np.unique(code[i] * len(names) + code[j], return_inverse=True)
                out = np.zeros(len(cell), np.int64)
                np.add.at(out, inverse, value)
                yield rows_of(*np.divmod(cell, len(names)), out)

    def closed():
        i, j = np.nonzero(square)
        if len(i):
            yield rows_of(i, j, square[i, j])

    def whole(table):
        """Rows of one language whose terms are complete."""
        p, none = (table.column(c).to_numpy() for c in ("p", "none"))
        code = np.array([place.setdefault(s, len(place)) for s in table.column("source").to_pylist()], np.int64)
        names.extend(list(place)[len(names):])
        term = table.column("term").combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
        yield from add(term, code, p, none)

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        while table.num_rows:
            langs = table.column("lang").to_pylist()
            if langs[0] != lang:
                yield from closed()
                lang, place, names, square = langs[0], {}, [], np.zeros((0, 0), np.int64)
            n = next((k for k, x in enumerate(langs) if x != lang), len(langs))
            if n == len(langs):  # the last term may go on in the next batch
                terms = table.column("term").to_pylist()
                while n and terms[n - 1] == terms[-1]:
                    n -= 1
                yield from whole(table.slice(0, n))
                table = table.slice(n)
                break
            yield from whole(table.slice(0, n))
            table = table.slice(n)
        rest = table.combine_chunks()
    if rest is not None and rest.num_rows:
        yield from whole(rest)
    yield from closed()


def pair_divergence(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, source, item, value): every ordered pair of sources of a language."""
    none = share(F.lit(0).cast("long"), F.col("total"), F.col("v"))
    groups = sizes.select("lang", "source", "total", "v", none.alias("none"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("none").alias("item_none"))
    # terms that neither has: the same amount each; corrected below where one or both have them
    base = (groups.join(other, "lang").filter("source != item")
            .select("lang", "source", "item", F.coalesce(F.col("v") * gap(F.col("none"), F.col("item_none")), F.lit(0)).alias("value")))
    sized = counts.join(groups, ["lang", "source"]).select("lang", "source", "term", "none", share(F.col("n"), F.col("total"), F.col("v")).alias("p"))
    kinds = sized.groupBy("lang", "source", "none", "p").agg(F.count(F.lit(1)).alias("terms"))
    one = kinds.join(other, "lang").filter("source != item")
    mine = one.select("lang", "source", "item", (F.col("terms") * (gap(F.col("p"), F.col("item_none")) - gap(F.col("none"), F.col("item_none")))).alias("value"))
    theirs = one.select("lang", F.col("item").alias("source"), F.col("source").alias("item"),
                        (F.col("terms") * (gap(F.col("item_none"), F.col("p")) - gap(F.col("item_none"), F.col("none")))).alias("value"))
    both = (sized.repartition("lang", "term").sortWithinPartitions("lang", "term")
            .mapInArrow(shared_pairs, "lang string, source string, item string, value long"))
    return (base.unionByName(mine).unionByName(theirs).unionByName(both)
            .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))


def term_excess(counts: DataFrame, sizes: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, item, value, rank): each group's terms that it has more
    of than its language, the ``top`` of them."""
    rows = counts.join(sizes, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), share(F.col("n"), F.col("total"), F.col("v")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q"))
    rows = rows.filter("p > q").select("lang", "source", "item", gap(F.col("p"), F.col("q")).alias("value"))
    return top_n_per_group(rows, ["lang", "source"], [F.col("value").desc(), F.col("item").asc()], top, rank_col="rank")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair``, the divergence
    of each source from each other one of its language; part ``term``, the
    terms that set a source apart from its language."""
    counts = staged(term_counts(docs, min_docs), "term-counts")
    sizes = staged(group_sizes(docs, counts), "group-sizes")
    in_group = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    pairs = staged(pair_divergence(counts, sizes), "pairs").withColumn("rank", F.row_number().over(in_group))
    parts = [(pairs, "pair"), (term_excess(counts, sizes, top), "term")]
    pair, term = (p.select("lang", "source", F.lit(name).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank"))
                  for p, name in parts)
    return pair.unionByName(term)
