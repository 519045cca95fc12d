"""MinHash near-dedup by a multi-index Hamming join.

1. Where a text is read it becomes its set of distinct five-word shingles
   (64-bit hashes), of which only a digest and minhash signatures go on.
   Texts with the same set are one class, represented by its least doc_id.
2. A signature has chunks of positions. Each chunk is indexed once per
   allowed error: one position is left out, so two chunks with at most one
   differing position share a key. By the pigeonhole principle all pairs whose
   signatures differ in at most ``2 * chunks - 1`` positions meet in a key.
   Beyond that distance errors fall at random: with 11 chunks of 4 positions a
   pair of similarity 0.75 fails to meet with probability 0.262^11 = 4e-7.
3. Classes in a key of more than ``LARGE`` (they share a passage, or are a
   large group of copies) are indexed again by an independent signature of 32
   chunks of 8 positions, which texts that only share a passage hardly ever
   agree in; 0.75 fails to meet with probability (1 - 0.367)^32 = 4e-7.
4. Pairs that meet are compared by 256-bit sketches (one bit a position) and
   those within ``SKETCH_DISTANCE`` (over five deviations above the mean of
   similarity 0.75) connect their classes to candidate clusters. A key of the
   second index with more than ``LARGE`` classes links them to its least one
   instead, without comparison, so a hot key costs its size.
5. Links are confirmed on full shingle sets, inside clusters. Clusters are
   hashed into blocks of about ``BLOCK`` classes; a task compares the pairs of
   a block and returns a spanning forest of the links. Large clusters are
   blocked twice at random, which joins nearly all of a group of copies;
   classes still outside the cluster's main component are then compared
   with all others of the cluster, block by block. Pairs that are connected
   already need no comparison: no link that matters is lost and no group is
   collected or expanded into all its pairs.
6. Components of the confirmed links are joined back to all rows.

Defined results: a null or empty text has no shingles and is linked with
nothing; fewer than five words are one shingle. Rows without doc_id are linked
with nothing (component null, kept). Rows that repeat a doc_id are versions
of one document and share its component, the least doc_id that any of them
reaches; dropping is by text, so a version stays if no text like it does. Ties
do not arise: the least doc_id represents, among texts of one doc_id that of
least digest. An empty table gives an empty result; columns but ``doc_id`` and
``text`` are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, free_name, per_process, staged, with_ids, without_ids
from tessera.llm.components import components
from tessera.operators.ordering import with_position

WORDS = 5
PERCENT = 75
#: (chunks, positions of a chunk) of the first and of the second signature.
FIRST, SECOND = (11, 4), (32, 8)
SKETCH_BITS = 256
SKETCH_DISTANCE = 60
LARGE = 4096
BLOCK = 128
SEED = 11


def constants():
    """Byte values, the base of the polynomial hash and its inverse, and the
    multipliers of the minhash functions."""
    import numpy as np

    rng = np.random.default_rng(SEED)
    odd = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    table, base = odd(256), int(odd(1)[0])
    n = {"first": FIRST[0] * FIRST[1], "second": SECOND[0] * SECOND[1], "sketch": SKETCH_BITS}
    functions = {k: (odd(m), odd(m)) for k, m in n.items()}
    return {"table": table, "base": base, "inverse": pow(base, -1, 1 << 64), **functions,
            "up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(c, n: int) -> None:
    import numpy as np

    if len(c["up"]) < n:
        n = max(n, 1 << 16)
        for name, base in (("up", c["base"]), ("down", c["inverse"])):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            c[name] = np.cumprod(p)


def shingles(text: str | None, c):
    """Sorted distinct 64-bit hashes of the five-word shingles of a text."""
    import numpy as np

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII case and white space
    if not words:
        return np.empty(0, np.uint64)
    data = np.frombuffer(b" ".join(words), np.uint8)
    _powers(c, len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(c["table"][data] * c["up"][:len(data)], out=sums[1:])
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    k = min(WORDS, len(words))
    starts, ends = starts[:len(words) - k + 1], ends[k - 1:]
    h = (sums[ends] - sums[starts]) * c["down"][starts] + (ends - starts).astype(np.uint64)
    return np.unique(mixed(h))


def mixed(h):
    """A bijective finaliser, so that all bits depend on all bits."""
    import numpy as np

    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def minhashes(h, functions):
    """The least value of each hash function over the set, 32 bits."""
    import numpy as np

    mul, add = functions
    out = np.full(len(mul), 0xFFFFFFFF, np.uint64)
    for i in range(0, len(h), 1024):
        part = h[i:i + 1024]
        for k in range(0, len(out), 64):
            v = mul[k:k + 64, None] * part
            v += add[k:k + 64, None]
            out[k:k + 64] = np.minimum(out[k:k + 64], v.min(axis=1) >> np.uint64(32))
    return out


def chunk_keys(signature, chunks: int, rows: int):
    """One key per chunk and left-out position of a signature."""
    import numpy as np

    part = signature.astype(np.uint64).reshape(chunks, rows)
    each = mixed((part << np.uint64(16)) + np.arange(rows, dtype=np.uint64)
                 + (np.arange(chunks, dtype=np.uint64)[:, None] << np.uint64(50)))
    whole = each.sum(axis=1, dtype=np.uint64)[:, None] - each
    place = np.arange(chunks * rows, dtype=np.uint64).reshape(chunks, rows)
    return mixed(whole + place * np.uint64(0x9E3779B97F4A7C15)).ravel().view(np.int64)


def _signatures(batches):
    import hashlib

    import numpy as np
    import pyarrow as pa

    c = per_process("near-dedup", constants)
    for b in batches:
        n, digest, sig, sketch = [], [], [], []
        for t in b.column("text"):
            h = shingles(t.as_py(), c)
            n.append(len(h))
            if not len(h):
                digest.append(None)
                sig.append(None)
                sketch.append(None)
                continue
            digest.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest())
            sig.append(minhashes(h, c["first"]).astype("<u4").tobytes())
            sketch.append(np.packbits((minhashes(h, c["sketch"]) & np.uint64(1)).astype(np.uint8)).tobytes())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                                          pa.array(sig, pa.binary()), pa.array(sketch, pa.binary())],
                                         names=["doc_id", "n_shingles", "digest", "sig", "sketch"])


def _first_keys(batches):
    import numpy as np
    import pyarrow as pa

    for b in batches:
        if b.num_rows:
            keys = [chunk_keys(np.frombuffer(s.as_py(), "<u4"), *FIRST) for s in b.column("sig")]
            ids = np.repeat(b.column("id").to_numpy(), FIRST[0] * FIRST[1])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(ids)], names=["key", "id"])


def _second_keys(batches):
    import numpy as np
    import pyarrow as pa

    c = per_process("near-dedup", constants)
    for b in batches:
        for i, t in zip(b.column("id").to_pylist(), b.column("text")):
            h = shingles(t.as_py(), c)
            if len(h):
                keys = chunk_keys(minhashes(h, c["second"]) & np.uint64(0xFFFF), *SECOND)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.full(len(keys), i))], names=["key", "id"])


def _sets(batches):
    import pyarrow as pa

    c = per_process("near-dedup", constants)
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([shingles(t.as_py(), c).tobytes() for t in b.column("text")], pa.binary())],
                                         names=["id", "shingles"])


class Forest:
    """Union-find over 0..n-1 that keeps the joining edges."""

    def __init__(self, n: int):
        self.up, self.edges = list(range(n)), []

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.up[max(a, b)] = min(a, b)
            self.edges.append((i, j))


def runs(batches, keys):
    """(key, columns) of the consecutive rows that share a key, where the
    columns are lists; one run at a time is held."""
    now, held = None, None
    for b in batches:
        cols = [c.to_pylist() for c in b.columns]
        at = list(zip(*[cols[b.schema.get_field_index(k)] for k in keys]))
        i = 0
        while i < len(at):
            j = i
            while j < len(at) and at[j] == at[i]:
                j += 1
            if held is not None and at[i] == now:
                for h, c in zip(held, cols):
                    h += c[i:j]
            else:
                if held is not None:
                    yield now, dict(zip(b.schema.names, held))
                now, held = at[i], [c[i:j] for c in cols]
            i = j
    if held is not None:
        yield now, dict(zip(b.schema.names, held))


def fresh(edges, most: int = 200_000):
    """Edges between ids that earlier edges of the task don't connect yet; the
    memory of them is emptied at ``most`` ids, which only repeats edges."""
    up: dict[int, int] = {}

    def root(i):
        while (j := up.setdefault(i, i)) != i:
            up[i] = i = up[j]
        return i

    for a, b in edges:
        x, y = root(a), root(b)
        if x != y:
            up[max(x, y)] = min(x, y)
            yield a, b
            if len(up) > most:
                up.clear()


def _edge_batches(edges):
    import pyarrow as pa

    held: list[tuple[int, int]] = []

    def made():
        return pa.RecordBatch.from_arrays([pa.array([e[k] for e in held], pa.int64()) for k in (0, 1)], names=["a", "b"])

    for e in fresh(edges):
        held.append(e)
        if len(held) >= 4096:
            yield made()
            held = []
    if held:
        yield made()


def sketch_forest(ids, sketches):
    """Edges that connect ids whose sketches are within ``SKETCH_DISTANCE``."""
    import numpy as np

    bits = np.frombuffer(b"".join(sketches), np.uint64).reshape(len(ids), -1)
    tree = Forest(len(ids))
    for i in range(len(ids) - 1):
        near = np.bitwise_count(bits[i + 1:] ^ bits[i]).sum(axis=1) <= SKETCH_DISTANCE
        for j in np.flatnonzero(near):
            tree.join(i, i + 1 + int(j))
    return [(ids[i], ids[j]) for i, j in tree.edges]


def _meet(batches):
    return _edge_batches(e for _, r in runs(batches, ["key"]) if len(r["id"]) > 1 for e in sketch_forest(r["id"], r["sketch"]))


def link_forest(ids, sets, left=None):
    """Edges of a spanning forest of all links among the sets (sorted uint64
    bytes); with ``left``, of the links that have an end there."""
    import numpy as np

    arrays = [np.frombuffer(s, np.uint64) for s in sets]
    n, tree = len(arrays), Forest(len(arrays))
    size = np.array([len(a) for a in arrays], np.int64)

    def linked(inter, i, j):
        return 100 * inter >= PERCENT * (size[i] + size[j] - inter)

    rows = range(n) if left is None else [i for i in range(n) if left[i]]
    if n <= 8:
        for i in rows:
            for j in range(i + 1 if left is None else 0, n):
                small, big = sorted((size[i], size[j]))
                if i != j and tree.root(i) != tree.root(j) and 100 * small >= PERCENT * big:
                    if linked(len(np.intersect1d(arrays[i], arrays[j], assume_unique=True)), i, j):
                        tree.join(i, j)
    else:
        owner = np.repeat(np.arange(n), size)
        _, word, count = np.unique(np.concatenate(arrays), return_inverse=True, return_counts=True)
        shared = count > 1
        number = np.cumsum(shared) - 1
        keep = shared[word]
        owner, word = owner[keep], number[word[keep]]
        order = np.argsort(word, kind="stable")
        owner, word = owner[order], word[order]
        inter = np.zeros((n, n), np.float32)
        for at in range(0, int(shared.sum()), 4096):
            a, b = np.searchsorted(word, [at, at + 4096])
            m = np.zeros((n, 4096), np.float32)
            m[owner[a:b], word[a:b] - at] = 1
            inter += m @ m.T
        inter = np.rint(inter).astype(np.int64)
        for i in rows:
            yes = linked(inter[i], i, slice(None))
            for j in np.flatnonzero(yes):
                if j > i or left is not None and j != i:
                    tree.join(i, int(j))
    return [(ids[i], ids[j]) for i, j in tree.edges]


def _confirm(keys):
    def run(batches):
        return _edge_batches(e for _, r in runs(batches, keys) if len(r["id"]) > 1 for e in link_forest(r["id"], r["shingles"]))
    return run


def _confirm_left(batches):
    def edges():
        for _, r in runs(batches, ["cluster", "lblock", "cblock"]):
            best: dict[int, int] = {}  # a class may come as left and as other: once is enough
            for k, (i, is_left) in enumerate(zip(r["id"], r["left"])):
                if i not in best or is_left:
                    best[i] = k
            at = list(best.values())
            if len(at) > 1:
                yield from link_forest([r["id"][k] for k in at], [r["shingles"][k] for k in at], [r["left"][k] for k in at])
    return _edge_batches(edges())


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest of the set, first signature and sketch."""
    rows = docs.selectExpr("cast(doc_id AS long) AS doc_id", "text")
    return rows.mapInArrow(_signatures, "doc_id long, n_shingles long, digest binary, sig binary, sketch binary")


def meetings(keys: DataFrame, name: str) -> DataFrame:
    """(key, id, hub, n) of the keys that n > 1 ids share; hub is the least."""
    shared = keys.groupBy("key").agg(F.min("id").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return staged(keys.join(staged(shared, f"{name}-shared"), "key"), name)


def near_pairs(rows: DataFrame, sketches: DataFrame) -> DataFrame:
    """Edges (a, b) that connect the near sketches of each key."""
    few = rows.join(sketches, "id").select("key", "id", "sketch")
    return few.repartition("key").sortWithinPartitions("key", "id").mapInArrow(_meet, "a long, b long")


def candidate_links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges (a, b) that connect classes into candidate clusters."""
    sketches = classes.select("id", "sketch")
    met = meetings(classes.select("id", "sig").mapInArrow(_first_keys, "key long, id long"), "near-first")
    links = near_pairs(met.filter(f"n <= {LARGE}"), sketches)
    again = staged(met.filter(f"n > {LARGE}").select("id").distinct(), "near-again")
    if again.isEmpty():
        return links
    texts = with_ids(docs.selectExpr("cast(doc_id AS long) AS doc_id", "text"), again)
    keys = texts.selectExpr("doc_id AS id", "text").mapInArrow(_second_keys, "key long, id long")
    met = meetings(staged(keys, "near-second-keys"), "near-second")
    hot = met.filter(f"n > {LARGE} AND id != hub").select(F.col("hub").alias("a"), F.col("id").alias("b"))
    return links.union(near_pairs(met.filter(f"n <= {LARGE}"), sketches)).union(hot)


def confirmed_links(docs: DataFrame, clusters: DataFrame) -> DataFrame:
    """Spanning links (a, b), confirmed on full sets, of candidate clusters
    (id, component)."""
    size = staged(clusters.groupBy("component").agg(F.count(F.lit(1)).alias("g")), "near-sizes")
    member = staged(clusters.join(size, "component").select(
        "id", F.col("component").alias("cluster"), F.ceil(F.col("g") / BLOCK).alias("nb")), "near-members")
    texts = with_ids(docs.selectExpr("cast(doc_id AS long) AS doc_id", "text"), member.select("id"))
    sets = texts.select(F.col("doc_id").alias("id"), "text").mapInArrow(_sets, "id long, shingles binary")
    sets = staged(sets.join(member, "id"), "near-sets")

    def block(salt, n="nb"):
        return F.pmod(F.xxhash64(F.col("id"), F.lit(salt)), F.col(n))

    def within(rows, salt):
        keyed = rows.select("cluster", block(salt).alias("block"), "id", "shingles")
        keyed = keyed.repartition("cluster", "block").sortWithinPartitions("cluster", "block", "id")
        return keyed.mapInArrow(_confirm(["cluster", "block"]), "a long, b long")

    large = sets.filter("nb > 1")
    links = staged(within(sets, 1).union(within(large, 2)), "near-links")
    if large.isEmpty():
        return links
    member = member.filter("nb > 1")
    found = components(links)
    member = staged(member.join(found, "id", "left").withColumn("component", F.coalesce("component", "id")), "near-members")
    count = member.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("n"))
    main = count.groupBy("cluster").agg(F.max(F.struct("n", "component"))["component"].alias("main"), F.sum("n").alias("g"),
                                        F.max("n").alias("most"))
    main = staged(main.select("cluster", "main", F.ceil((F.col("g") - F.col("most")) / BLOCK).alias("nl")).filter("nl > 0"), "near-main")
    member = staged(member.join(main, "cluster").select("id", "nl", (F.col("component") != F.col("main")).alias("left")), "near-left")
    rows = large.join(member, "id")
    every = rows.select("cluster", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nl") - 1)).alias("lblock"),
                        block(3).alias("cblock"), "id", "shingles", F.lit(False).alias("left"))
    left = rows.filter("left").select("cluster", block(4, "nl").alias("lblock"),
                                      F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)).alias("cblock"),
                                      "id", "shingles", F.lit(True).alias("left"))
    keys = ["cluster", "lblock", "cblock"]
    pairs = every.unionByName(left).repartition(*keys).sortWithinPartitions(*keys, "id")
    return links.union(staged(pairs.mapInArrow(_confirm_left, "a long, b long"), "near-links"))


def _near(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of each row of ``docs``, whose ids
    have one text each; ``rows`` are their signatures."""
    linked = rows.filter("digest IS NOT NULL AND doc_id IS NOT NULL")
    classes = staged(linked.groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("sig").alias("sig"),
                                                  F.first("sketch").alias("sketch")), "near-classes")
    clusters = components(staged(candidate_links(docs, classes), "near-candidates"))
    found = components(confirmed_links(docs, clusters))
    ids = classes.select("digest", "id").join(found, "id", "left").select("digest", F.coalesce("component", "id").alias("component_id"))
    ids = staged(ids, "near-components")
    out = linked.select("doc_id", "n_shingles", "digest").join(ids, "digest").select("doc_id", "n_shingles", "component_id")
    alone = rows.filter("digest IS NULL OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.unionByName(alone)


def _several_texts(rows: DataFrame) -> bool:
    """Whether some doc_id comes with more than one set of shingles."""
    own = F.coalesce("digest", F.lit(b""))
    sets = rows.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(own).alias("a"), F.max(own).alias("b"))
    return not sets.filter("a != b").isEmpty()


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number (the column's name is returned) for each
    different (doc_id, text), in the order of doc_id; null without doc_id."""
    number, name = free_name(docs, "number"), free_name(docs, "text_sha")
    sha = F.sha2(F.coalesce("text", F.lit("")), 256)
    ids = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), sha.alias(name)).distinct()
    numbers = staged(with_position(ids, ["doc_id", name], "position"), "near-numbers").withColumnRenamed("doc_id", "of_doc")
    same = (docs["doc_id"].cast("long") == numbers["of_doc"]) & (sha == numbers[name])
    return docs.join(numbers, same, "left").select(*[docs[c] for c in docs.columns], numbers["position"].alias(number)), number


def _near_by_number(docs: DataFrame, number: str) -> DataFrame:
    """number, n_shingles and component (a number) of each text."""
    texts = staged(docs.select(F.col(number).alias("doc_id"), "text"), "near-texts")
    found = _near(texts, staged(signatures(texts), "near-signatures"))
    return found.select(F.col("doc_id").alias("number"), "n_shingles", F.col("component_id").alias("component"))


def near_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``docs``."""
    bounded_batches(docs.sparkSession, 256)
    rows = staged(signatures(docs), "near-signatures")
    if _several_texts(rows):
        out = _of_versions(docs)
    else:
        out = _near(docs, rows)
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _of_versions(docs: DataFrame) -> DataFrame:
    """Components where a doc_id has several texts: its texts are numbered
    and linked as if they were documents, then the components that one doc_id
    is in are one."""
    own, number = _numbered(docs)
    ids = own.select(F.col(number).alias("number"), F.col("doc_id").cast("long").alias("doc_id")).filter("number IS NOT NULL").distinct()
    ids = staged(ids, "near-ids")
    found = staged(_near_by_number(own, number), "near-by-number")
    rows = found.filter("number IS NOT NULL").join(ids, "number")
    least = rows.groupBy("doc_id").agg(F.min("component").alias("least"))
    links = rows.join(least, "doc_id").filter("least != component").select(F.col("least").alias("a"), F.col("component").alias("b")).distinct()
    merged = components(staged(links, "near-version-links")).select(F.col("id").alias("component"), F.col("component").alias("whole"))
    whole = rows.join(merged, "component", "left").select("doc_id", "n_shingles", F.coalesce("whole", "component").alias("number"))
    named = ids.select("number", F.col("doc_id").alias("component_id"))
    none = F.lit(None).cast("long")
    without = found.filter("number IS NULL").select(none.alias("doc_id"), "n_shingles", none.alias("component_id"))
    return whole.join(named, "number").select("doc_id", "n_shingles", "component_id").unionByName(without)


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that represent their group, own columns only. A
    doc_id with several texts stays with those that represent a group of
    texts, so no text goes whose like doesn't stay."""
    bounded_batches(docs.sparkSession, 256)
    rows = staged(signatures(docs), "near-signatures")
    if not _several_texts(rows):
        gone = _near(docs, rows).filter("doc_id != component_id").select("doc_id").distinct()
        return without_ids(docs, staged(gone, "near-dropped"))
    own, number = _numbered(docs)
    gone = _near_by_number(own, number).filter("number != component").select(F.col("number").alias("gone")).distinct()
    gone = staged(gone, "near-dropped")
    return own.join(gone, own[number] == gone["gone"], "left_anti").drop(number)
