"""Repeated passages by a logarithmic family of sparse suffix arrays.

Every byte inside a ``LENGTH``-byte string that starts anywhere else too is
marked, on the texts as they come.

Suffixes are sampled by content: of the ``GRAM``-byte strings inside a
window the one with the least hash is the window's anchor, so equal windows
have equal anchors at the same offset, and a text of n bytes has about
n / 70 anchors. The bytes of all windows that share an anchor are a *piece*
(at most ``2 * LENGTH - GRAM`` bytes).

1. A first pass counts anchor grams; a gram that occurs once can't lie in a
   repeated window. A second pass keeps the anchors of the others, each with
   the hash of its piece. A piece that occurs twice or more is repeated whole.
2. The distinct pieces of a gram that has several go, by gram, through the
   index family: a batch of pieces gets its suffix array (window starts in
   byte order, compared to LENGTH bytes), is scanned for neighbours with
   equal LENGTH-byte prefixes, is merge-scanned against every existing level,
   and equal-sized levels merge, so a suffix is merged a logarithmic number
   of times. Only batches and levels of one chunk of grams are in memory.
3. The pieces of a gram with more than ``LARGE`` distinct ones (a passage
   shared by very many texts, where it begins and ends) are dealt out by
   content first, by the bytes that ranges of their windows share, until a
   group fits a chunk and goes through the index family, or all windows of a
   range are known to be repeated (``large_grams``). A piece has a few rows a
   round, in at most as many rounds as the distance of a window from its anchor has
   bits; counts combine before they are shuffled.
4. The repeated stretches of a text are merged and cut out in one pass.

Work is by text: copies of a text carry the same 128-bit digest, count as
occurrences and share one result. Keys that a third of all rows share are
pre-aggregated before they are shuffled, or sides of plain joins.

Defined results: a null text is empty; texts under LENGTH bytes lose nothing.
Repeated rows are occurrences like any others, a null id is passed through,
an empty table gives an empty result; columns but ``doc_id`` and ``text`` are
ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import SLOTS, bounded_batches, per_process, staged

LENGTH = 200
GRAM = 64
#: Distinct pieces of one gram that one task compares at most.
LARGE = 512
#: Pieces of a batch, and of a chunk of grams.
BATCH, CHUNK = 256, 1024
SEED = 23
#: Texts are hashed in stretches of this many bytes, overlapping by a window.
STRETCH = 1 << 20


def constants():
    import numpy as np

    rng = np.random.default_rng(SEED)
    base = int(rng.integers(0, 1 << 62)) * 2 + 1
    c = {"table": rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)}
    for name, b in (("up", base), ("down", pow(base, -1, 1 << 64))):
        p = np.full(STRETCH + LENGTH + 1, b, np.uint64)
        p[0] = 1
        c[name] = np.cumprod(p)
    return c


def mixed(h):
    import numpy as np

    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _sums(data, c):
    import numpy as np

    s = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(c["table"][data] * c["up"][:len(data)], out=s[1:])
    return s


def anchors(text: bytes, c):
    """(start of the first window, windows, gram hash, piece hash, bytes from
    the first window's start to the anchor) per anchor."""
    import numpy as np

    width = LENGTH - GRAM + 1
    out = []
    for at in range(0, max(0, len(text) - LENGTH + 1), STRETCH):
        data = np.frombuffer(text[at:at + STRETCH + LENGTH - 1], np.uint8)
        s, m = _sums(data, c), len(data) - GRAM + 1
        h = mixed((s[GRAM:] - s[:-GRAM]) * c["down"][:m])
        order = h >> np.uint64(24) << np.uint64(24) | np.arange(m, dtype=np.uint64)  # least hash, then first
        blocks = np.concatenate([order, np.full(-m % width, (1 << 64) - 1, np.uint64)]).reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        n = m - width + 1
        place = (np.minimum(back[:n], ahead[width - 1:width - 1 + n]) & np.uint64((1 << 24) - 1)).astype(np.int64)
        cut = np.flatnonzero(np.diff(place)) + 1
        first, last = np.concatenate([[0], cut]), np.concatenate([cut, [n]]) - 1
        piece = mixed((s[last + LENGTH] - s[first]) * c["down"][first] + (last - first).astype(np.uint64))
        out.append((first + at, last - first + 1, h[place[first]], piece, place[first] - first))
    if not out:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*out))


def encoded(value) -> bytes:
    return (value or "").encode("utf-8", "surrogatepass")


def text_id(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()[:16]


def _grams(batches):
    import pyarrow as pa

    c = per_process("suffix-dedup", constants)
    for b in batches:
        for t in b.column("text"):
            g = anchors(encoded(t.as_py()), c)[2]
            if len(g):
                yield pa.RecordBatch.from_arrays([pa.array(g.view("int64"))], names=["gram"])


def _pieces(batches):
    """Anchors with (tid, place): place packs the first window, the anchor's
    distance from it and the number of windows."""
    import numpy as np
    import pyarrow as pa

    c = per_process("suffix-dedup", constants)
    for b in batches:
        for t in b.column("text"):
            data = encoded(t.as_py())
            first, n, gram, piece, ahead = anchors(data, c)
            if len(first):
                tid = pa.array([text_id(data)], pa.binary()).take(pa.array(np.zeros(len(first), np.int64)))
                yield pa.RecordBatch.from_arrays([tid, pa.array(first << 16 | ahead << 8 | n), pa.array(gram.view("int64")), pa.array(piece.view("int64"))],
                                                 names=["tid", "place", "gram", "piece"])


def _cut_pieces(batches):
    """The bytes of the pieces that a text is to give: rows (text, wanted)."""
    import pyarrow as pa

    for b in batches:
        gram, piece, n, ahead, data = [], [], [], [], []
        for t, wanted in zip(b.column("text"), b.column("wanted").to_pylist()):
            text = encoded(t.as_py())
            for w in wanted:
                first, windows = w["place"] >> 16, w["place"] & 255
                ahead.append(w["place"] >> 8 & 255)
                gram.append(w["gram"])
                piece.append(w["piece"])
                n.append(w["n"])
                data.append(text[first:first + windows + LENGTH - 1])
        yield pa.RecordBatch.from_arrays([pa.array(gram, pa.int64()), pa.array(piece, pa.int64()), pa.array(n, pa.int64()),
                                          pa.array(ahead, pa.int64()), pa.array(data, pa.binary())], names=["gram", "piece", "n", "ahead", "data"])


class Family:
    """Suffix arrays of pieces in levels; ``low`` and ``high`` get the first and
    the last repeated window of each piece."""

    def __init__(self):
        self.levels, self.low, self.high = {}, [], []

    def _mark(self, text, owner, place) -> None:
        """Neighbours with equal prefixes in a sorted array are repeats."""
        import numpy as np

        same = text[1:] == text[:-1]
        hit = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))
        for o, p in zip(owner[hit].tolist(), place[hit].tolist()):
            self.low[o] = min(self.low[o], p)
            self.high[o] = max(self.high[o], p)

    @staticmethod
    def array(pieces, first: int):
        """The suffix array of a batch: windows in byte order, owner and place."""
        import numpy as np

        text, owner, place = [], [], []
        for k, data in enumerate(pieces):
            windows = np.lib.stride_tricks.sliding_window_view(np.frombuffer(data, np.uint8), LENGTH)
            text.append(windows)
            owner.append(np.full(len(windows), first + k))
            place.append(np.arange(len(windows)))
        text = np.ascontiguousarray(np.concatenate(text)).view(f"S{LENGTH}").ravel()
        order = np.argsort(text, kind="stable")
        return text[order], np.concatenate(owner)[order], np.concatenate(place)[order]

    @staticmethod
    def merged(a, b):
        """Two sorted arrays as one, by the places of the one in the other."""
        import numpy as np

        at = np.searchsorted(a[0], b[0], side="right") + np.arange(len(b[0]))
        rest = np.ones(len(a[0]) + len(b[0]), bool)
        rest[at] = False
        out = []
        for x, y in zip(a, b):
            z = np.empty(len(rest), x.dtype)
            z[at], z[rest] = y, x
            out.append(z)
        return tuple(out)

    def add(self, pieces) -> None:
        first = len(self.low)
        self.low += [1 << 30] * len(pieces)
        self.high += [-1] * len(pieces)
        new = self.array(pieces, first)
        self._mark(*new)
        size = 0
        for level in self.levels.values():
            self._mark(*self.merged(level, new))
        while size in self.levels:
            new = self.merged(self.levels.pop(size), new)
            size += 1
        self.levels[size] = new


def _scan(batches):
    """Rows (key, gram, piece, n, data) sorted by key -> low and high of each
    piece; pieces of one key lie in one chunk."""
    import pyarrow as pa

    def done(rows):
        rows = list({(r[1], r[2]): r for r in rows}.values())  # a piece may come by several keys
        family = Family()
        for i in range(0, len(rows), BATCH):
            family.add([r[4] for r in rows[i:i + BATCH]])
        out = []
        for (_, gram, piece, n, data), low, high in zip(rows, family.low, family.high):
            if n > 1:
                low, high = 0, len(data) - LENGTH
            if high >= 0:
                out.append((gram, piece, low, high))
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(4)], names=["gram", "piece", "low", "high"])

    held: list[tuple] = []
    for b in batches:
        for r in zip(*[c.to_pylist() for c in b.columns]):
            if len(held) >= CHUNK and r[0] != held[-1][0]:
                yield done(held)
                held = []
            held.append(r)
    if held:
        yield done(held)


def distances():
    """Ranges (nearest, farthest) of the distance from a window's start to its
    anchor, each twice as wide as the one before."""
    out, low = [(0, 0)], 1
    while low <= LENGTH - GRAM:
        out.append((low, min(2 * low - 1, LENGTH - GRAM)))
        low *= 2
    return out


def _hash16(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _keys(batches):
    """Per piece and range of distances two hashes: of the bytes that all
    windows of the range share (core), and of all bytes that they cover (hull;
    null if the piece doesn't hold the whole range). Rows (gram, piece, ahead,
    data, ranges with n) -> (core, hull, gram, piece, n, near, far, low, high)."""
    import pyarrow as pa

    for b in batches:
        out = []
        for gram, piece, ahead, data, ranges in zip(*[c.to_pylist() for c in b.columns]):
            nearest = ahead - (len(data) - LENGTH)
            for r in ranges:
                near, far = r["near"], r["far"]
                if near > ahead or far < nearest:
                    continue
                tag = bytes([near, far])
                hull = _hash16(tag + data[ahead - far:ahead - near + LENGTH]) if far <= ahead and near >= nearest else None
                core = _hash16(tag + data[ahead - near:ahead - far + LENGTH])
                out.append((core, hull, gram, piece, r["n"], near, far, ahead - far, ahead - near))
        kinds = [pa.binary()] * 2 + [pa.int64()] * 7
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)],
                                         names=["core", "hull", "gram", "piece", "n", "near", "far", "low", "high"])


def large_grams(many: DataFrame) -> DataFrame:
    """Marks (gram, piece, low, high) of the pieces of grams that have too many
    for one chunk; ``many`` has gram, piece, n, ahead and data.

    A window begins some bytes before its anchor. The ranges of this distance,
    each twice as wide as the one before, are looked at together: pieces that
    share the hull of a range repeat all its windows, and one of them goes on
    for all as a partner of others; pieces alone with its core repeat none.
    Where a core is shared by different hulls, few pieces go through the index
    family as one group, and many are looked at again in either half of the
    range. A piece is split only around the ends of what it shares, so it has
    about two ranges a round, and there is a round for each bit of the
    distance."""
    struct = lambda near, far, n: F.struct(near.cast("long").alias("near"), far.cast("long").alias("far"), n.cast("long").alias("n"))
    ranges = F.array(*[struct(F.lit(near), F.lit(far), F.col("n")) for near, far in distances()])
    data, marks = many.select("gram", "piece", "ahead", "data"), []
    work = many.select("gram", "piece", "ahead", "data", ranges.alias("ranges"))
    while True:
        keys = staged(work.mapInArrow(_keys, "core binary, hull binary, gram long, piece long, n long, near long, far long, low long, high long"), "suffix-keys")
        hulls = keys.filter("hull IS NOT NULL").groupBy("hull").agg(F.sum("n").alias("times"), F.min(F.struct("gram", "piece")).alias("one"))
        hulls = staged(hulls.filter("times > 1"), "suffix-hulls")
        marks.append(keys.join(hulls.select("hull"), "hull", "left_semi").select("gram", "piece", "low", "high"))
        wide = keys.filter("near < far")
        member = ["core", "gram", "piece", "near", "far"]
        alone = wide.join(hulls.select("hull"), "hull", "left_anti").select(*member, "n", F.lit(1).alias("open"))
        for_all = wide.join(hulls, "hull").filter(F.struct("gram", "piece") == F.col("one")).select(*member, F.col("times").alias("n"), F.lit(0).alias("open"))
        members = staged(alone.unionByName(for_all), "suffix-members")
        cores = members.groupBy("core").agg(F.sum("n").alias("times"), F.sum("open").alias("opens"), F.count(F.lit(1)).alias("d"))
        left = staged(members.join(cores.filter("times > 1 AND opens > 0").select("core", "d"), "core"), "suffix-open")
        few = left.filter(f"d <= {LARGE}").select(F.xxhash64("core").alias("key"), "gram", "piece")
        few = few.join(many, ["gram", "piece"]).select("key", "gram", "piece", "n", "data")
        few = few.repartition("key").sortWithinPartitions("key", "gram", "piece")
        marks.append(staged(few.mapInArrow(_scan, "gram long, piece long, low long, high long"), "suffix-marks"))
        mid = F.floor((F.col("near") + F.col("far")) / 2)
        halves = F.array(struct(F.col("near"), mid, F.col("n")), struct(mid + 1, F.col("far"), F.col("n")))
        split = left.filter(f"d > {LARGE}").select("gram", "piece", F.explode(halves).alias("r")).groupBy("gram", "piece").agg(
            F.collect_list("r").alias("ranges"))  # of one piece: a window's distances at most
        split = staged(split, "suffix-split")
        if split.isEmpty():
            break
        work = data.join(split, ["gram", "piece"]).select("gram", "piece", "ahead", "data", "ranges")
    out = marks[0]
    for m in marks[1:]:
        out = out.union(m)
    return out.groupBy("gram", "piece").agg(F.min("low").alias("low"), F.max("high").alias("high"))


def repeats(docs: DataFrame) -> DataFrame:
    """(tid, spans): the repeated stretches (start, end) of each distinct text,
    unmerged; texts without any are missing."""
    texts = docs.select("text")
    grams = texts.mapInArrow(_grams, "gram long").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    grams = staged(grams.filter("n > 1").select("gram"), "suffix-grams")
    found = texts.mapInArrow(_pieces, "tid binary, place long, gram long, piece long")
    found = staged(found.join(grams, "gram", "left_semi"), "suffix-anchors")
    pieces = found.groupBy("gram", "piece").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("tid", "place")).alias("at"))
    pieces = staged(pieces, "suffix-pieces")
    several = pieces.groupBy("gram").agg(F.count(F.lit(1)).alias("d"), F.min("n").alias("least")).filter("d > 1 AND least = 1")
    several = staged(several.select("gram", "d"), "suffix-several")
    whole = pieces.filter("n > 1").select("gram", "piece", F.lit(0).cast("long").alias("low"),
                                          (F.col("at.place").bitwiseAND(255) - 1).alias("high"))
    open_ = pieces.join(several, "gram").select("at.tid", F.struct("gram", "piece", "n", F.col("at.place").alias("place")).alias("w"), "d")
    wanted = staged(open_.groupBy("tid").agg(F.collect_list("w").alias("wanted")), "suffix-wanted")
    data = with_texts(docs, wanted).select("tid", "text", "wanted").dropDuplicates(["tid"]).select("text", "wanted")
    data = staged(data.mapInArrow(_cut_pieces, "gram long, piece long, n long, ahead long, data binary").join(several, "gram"), "suffix-data")
    few = data.filter(f"d <= {LARGE}").select(F.col("gram").alias("key"), "gram", "piece", "n", "data")
    few = few.repartition("key").sortWithinPartitions("key", "gram", "piece")
    few = few.mapInArrow(_scan, "gram long, piece long, low long, high long")
    marks = [whole, staged(few.join(pieces.filter("n = 1").select("gram", "piece"), ["gram", "piece"], "left_semi"), "suffix-marks")]
    many = data.filter(f"d > {LARGE}").select("gram", "piece", "n", "ahead", "data")
    if not many.isEmpty():
        once = large_grams(many).join(pieces.filter("n = 1").select("gram", "piece"), ["gram", "piece"], "left_semi")
        marks.append(staged(once, "suffix-marks"))
    marked = marks[0]
    for m in marks[1:]:
        marked = marked.union(m)
    first = F.shiftright("place", 16)
    spans = found.join(marked, ["gram", "piece"]).select(
        "tid", F.struct((first + F.col("low")).alias("start"), (first + F.col("high") + LENGTH).alias("end")).alias("span"))
    return staged(spans.groupBy("tid").agg(F.collect_set("span").alias("spans")), "suffix-spans")


def _tid(text):
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)), 1, 16)


def _slot(tid):
    return F.pmod(F.xxhash64(tid), F.lit(SLOTS))


def with_texts(docs: DataFrame, table: DataFrame, how: str = "inner") -> DataFrame:
    """Rows of ``docs`` (doc_id, text) joined with ``table`` on the text's id;
    only texts whose slot occurs in the table are shuffled."""
    rows = docs.selectExpr("cast(doc_id AS long) AS doc_id", "text").withColumn("tid", _tid(F.col("text")))
    slots = F.broadcast(table.select(_slot(F.col("tid")).alias("slot")).distinct())
    near = rows.join(slots, _slot(rows.tid) == slots.slot, "left_semi").join(table, "tid", how)
    if how == "inner":
        return near
    return near.unionByName(rows.join(slots, _slot(rows.tid) == slots.slot, "left_anti"), allowMissingColumns=True)


def merged_spans(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def kept_bytes(data: bytes, spans) -> bytes:
    at, out = 0, []
    for s, e in spans:
        out.append(data[at:s])
        at = e
    return b"".join(out) + data[at:]


def _cut(batches):
    import pyarrow as pa

    for b in batches:
        size, removed, runs, kept = [], [], [], []
        for t, spans in zip(b.column("text"), b.column("spans").to_pylist()):
            data = encoded(t.as_py())
            cut = merged_spans((x["start"], x["end"]) for x in spans or [])
            size.append(len(data))
            removed.append(sum(e - s for s, e in cut))
            runs.append([{"start": s, "end": e} for s, e in cut])
            kept.append(kept_bytes(data, cut))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, kind),
                                          pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "removed", "kept"])


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, the removed runs (start, end) and the bytes
    that stay."""
    bounded_batches(docs.sparkSession, 256)
    rows = with_texts(docs, repeats(docs), "left").select("doc_id", "text", "spans")
    return rows.mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, removed array<struct<start: long, end: long>>, kept binary")
