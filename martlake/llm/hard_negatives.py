"""Hard-negative mining with rotated one-bit codes.

Every row keeps, besides its integer vector z, ``LEVELS`` codes: the residual of the level before
(z minus the corpus mean, at first) is turned by a fixed random rotation, its signs are the code,
and its inner product with the code's unit vector, the code-vector alignment, is stored with the
length of what the code leaves. An anchor is turned alike and cut into bit planes, so popcounts of
code & plane estimate the inner product; what the planes round off and the residual that remains
(Cauchy-Schwarz) bound the error, for certain. Rows whose interval can't reach the best scores
found so far drop out level by level; those that survive all levels are scored as integers, so
results are those of an exhaustive search.

Data blocks meet anchor blocks; a block's size is bounded in bytes. The first pass finds every
anchor's positives (best rows of its label), the second, for each positive, the best rows of other
labels whose score lies in the window around the positive's. A hot label changes nothing: rows are
dealt by a hash of their id.

Rows with a null id, label or vector, an empty vector, or a null or non-finite component take no
part; only vectors of one length are compared. Rows that repeat an id are candidates each, a row
with the anchor's id is never its positive or negative, anchors that repeat as a whole count once.
Ties go to the smaller id. Components saturate after scaling at the caller's limit, +-2^27 unless
named; the query names a long's. Scores are exact whatever the components' size; only one that a
long can't hold (2^63 or more) stands at the long's end. Anchors without a positive, and
positives whose window is empty (a negative score), give no rows; empty tables give none. Extra
columns are ignored.
"""

from __future__ import annotations

import copy

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from martlake.llm import textkit as tk
from martlake.llm.whitening import whole

LEVELS = 3
#: bit planes an anchor is cut into
PLANES = 5
#: rows an anchor scores exactly in a block before any row is ruled out
PROBE = 64
_TOGETHER, _ROWS = 16, 2048
_BLOCK_BYTES, _LEAST_BLOCKS = 16 << 20, 24
#: where components stand unless the caller names another limit, and the largest one there is
_LIMIT, LONG = 1 << 27, (1 << 63) - 1


def rotation(dim: int, level: int) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    held = tk.worker_cache("rotations")
    if (dim, level) not in held:
        q, r = np.linalg.qr(np.random.default_rng([dim, level]).standard_normal((dim, dim)))
        held[dim, level] = q * np.sign(np.diagonal(r))
    return held[dim, level]


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    n, dim = bits.shape
    wide = np.zeros((n, -(-dim // 64) * 64), bool)
    wide[:, :dim] = bits
    return np.packbits(wide, axis=1, bitorder="little").view("<u8")


def encode(z: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, sizes) of the rows of z: for each level the code's words; for each level the
    alignment, and then the length of the residual that all codes leave."""
    rest, codes, sizes = z - centre, [], []
    dim = z.shape[1]
    for level in range(LEVELS):
        turned = rest @ rotation(dim, level).T
        align = np.abs(turned).sum(axis=1) / np.sqrt(dim)
        rest = turned - np.where(turned >= 0, 1.0, -1.0) * (align / np.sqrt(dim))[:, None]
        rest = rest @ rotation(dim, level)
        codes.append(_packed(turned >= 0))
        sizes.append(align)
    return np.concatenate(codes, axis=1), np.stack([*sizes, np.linalg.norm(rest, axis=1)], axis=1)


class Planes:
    """Anchors (rows of q) as bit planes for one level."""

    def __init__(self, q: np.ndarray, level: int):
        turned = q @ rotation(q.shape[1], level).T
        self.dim, self.root = q.shape[1], np.sqrt(q.shape[1])
        top = (1 << PLANES) - 1
        self.low = turned.min(axis=1)
        self.step = np.maximum((turned.max(axis=1) - self.low) / top, 1e-300)
        u = np.clip(np.rint((turned - self.low[:, None]) / self.step[:, None]), 0, top).astype(np.int64)
        kept = self.low[:, None] + self.step[:, None] * u
        self.total = kept.sum(axis=1)
        self.off = np.abs(turned - kept).sum(axis=1) / self.root
        self.masks = [_packed((u >> b) & 1 == 1) for b in range(PLANES)]

    def estimate(self, codes: np.ndarray, ones: np.ndarray) -> np.ndarray:
        """Inner products of the anchors with the unit vectors of ``codes`` (words x rows, ``ones``
        bits set in each row), off by at most ``self.off``."""
        shape = len(self.low), codes.shape[1]
        kind = np.uint16 if self.dim << PLANES < 1 << 16 else np.uint32
        both, bits = np.empty(shape, np.uint64), np.empty(shape, np.uint8)
        part, total = np.empty(shape, kind), np.zeros(shape, kind)
        for w in range(len(codes)):
            for b, mask in enumerate(self.masks):
                np.bitwise_and(mask[:, w, None], codes[w], out=both)
                np.bitwise_count(both, out=bits)
                np.multiply(bits, kind(1 << b), out=part, dtype=kind)
                np.add(total, part, out=total)
        out = total * (2 * self.step / self.root)[:, None]
        out += (2 * self.low / self.root)[:, None] * ones
        out -= (self.total / self.root)[:, None]
        return out


class Block:
    """The vectors of one length in a data block, in order of their labels."""

    def __init__(self, ids, labels, z, codes, sizes, centre):
        order = np.argsort(labels, kind="stable")
        self.ids, self.labels, z = ids[order], labels[order], z[order]
        self.z = z.astype(np.int64)
        self.real = z.astype(float)
        self.top = int(np.abs(self.z).max(initial=0))
        words = codes.shape[1] // LEVELS
        self.codes = [np.ascontiguousarray(codes[order, k * words:(k + 1) * words].T) for k in range(LEVELS)]
        self.ones = [np.bitwise_count(c).sum(axis=0, dtype=np.int64) for c in self.codes]
        self.align, self.rest = np.ascontiguousarray(sizes[order, :LEVELS].T), sizes[order, LEVELS]
        self.centre = centre
        self.slack = 1e-9 * (np.linalg.norm(self.real, axis=1).max(initial=0.0) + np.linalg.norm(centre) + 1)
        #: (row, anchor) pairs looked at, and those whose interval survived and were scored
        self.seen = np.zeros(2, np.int64)

    def intervals(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(estimates, half widths) of the inner products of anchors (rows of q) with all rows."""
        n, planes = len(self.ids), [Planes(q, level) for level in range(LEVELS)]
        length = np.linalg.norm(q, axis=1)[:, None]
        est = np.repeat((q @ self.centre)[:, None], n, axis=1)
        half = np.stack([p.off for p in planes], axis=1) @ self.align
        half += length * self.rest + self.slack * (length + 1)
        for i in range(0, n, _ROWS):
            for level, p in enumerate(planes):
                part = p.estimate(self.codes[level][:, i:i + _ROWS], self.ones[level][i:i + _ROWS])
                part *= self.align[level, i:i + _ROWS]
                est[:, i:i + _ROWS] += part
        return est, half

    def scorer(self, q):
        """A function (anchors, rows) -> exact scores of these pairs, arrays that broadcast."""
        reach = self.top * int(np.abs(q).max(initial=0)) * q.shape[1]
        if reach < 1 << 53:  # doubles hold every sum
            real = q.astype(float)
            return lambda a, rows: np.matmul(self.real[rows], real[a][..., None])[..., 0]
        if reach < 1 << 63:
            return lambda a, rows: np.matmul(self.z[rows], q[a][..., None])[..., 0]
        length, size = np.linalg.norm(q.astype(float), axis=1), np.linalg.norm(self.real, axis=1)

        def scores(a, rows):
            out = np.matmul(self.z[rows], q[a][..., None])[..., 0]  # right modulo 2^64
            a, rows = np.broadcast_arrays(np.asarray(a)[..., None], rows)
            for at in zip(*np.nonzero(length[a] * size[rows] > 2.0 ** 62)):
                exact = sum(x * y for x, y in zip(q[a[at]].tolist(), self.z[rows[at]].tolist()))
                out[at] = min(max(exact, -LONG), LONG)
            return out
        return scores

    def search(self, q, shown, windows, k):
        """For each anchor (row of q) and each of its windows [low, high] the ids and scores of
        the ``k`` best rows among those ``shown`` (anchors x rows), ties to the smaller id."""
        low, high = (np.array([f(w) for w in windows], float) for f in (lambda w: min(a for a, _ in w), lambda w: max(b for _, b in w)))
        scores, every = self.scorer(q), np.arange(len(q))
        self.seen[0] += shown.sum()
        if len(self.ids) > 2 * PROBE:
            est, half = self.intervals(q.astype(float))
            # exact scores of rows that seem good, the best of every PROBE-th row from each start,
            # give a score that each window surely reaches
            near = np.where(est > high[:, None], 2 * high[:, None] - est, est)
            near[~shown] = -np.inf
            wide = len(self.ids) // PROBE
            rows = near[:, :wide * PROBE].reshape(len(q), wide, PROBE).argmax(axis=1) * PROBE + np.arange(PROBE)
            sure = scores(every, rows)
            valid = np.take_along_axis(shown, rows, axis=1)
            for a, w in enumerate(windows):
                reached = []
                for x, y in w:
                    inside = sure[a, (sure[a] >= x) & (sure[a] <= y) & valid[a]]
                    reached.append(np.partition(inside, -k)[-k] if len(inside) >= k else x)
                low[a] = min(reached)
            shown = shown & (est + half >= low[:, None]) & (est - half <= high[:, None])
        left = int(shown.sum())
        self.seen[1] += left
        # one matrix product is cheaper than gathering rows when many are left
        exact = self.top * int(np.abs(q).max(initial=0)) * q.shape[1] < 1 << 53
        dense = q.astype(float) @ self.real.T if exact and 8 * left > shown.size else None
        out = []
        for a, w in enumerate(windows):
            rows = np.flatnonzero(shown[a])
            score = scores(a, rows) if dense is None else dense[a, rows]
            found = []
            for x, y in w:
                fit = np.flatnonzero((score >= x) & (score <= y))
                if len(fit) > k:
                    fit = fit[score[fit] >= np.partition(score[fit], -k)[-k]]
                best = fit[np.lexsort((self.ids[rows[fit]], -score[fit]))[:k]]
                found.append((self.ids[rows[best]], score[best].astype(np.int64)))
            out.append(found)
        return out

    def part(self, i, j):
        """The rows i to j as a block."""
        out = copy.copy(self)
        out.ids, out.labels, out.z, out.real = self.ids[i:j], self.labels[i:j], self.z[i:j], self.real[i:j]
        out.rest, out.align = self.rest[i:j], self.align[:, i:j]
        out.codes, out.ones = [c[:, i:j] for c in self.codes], [c[i:j] for c in self.ones]
        return out

    def span(self, label):
        """The places of the rows with this label."""
        return np.searchsorted(self.labels, [label, label + 1])


def _rows(column, kind, dim_items):
    data, off = tk.flat_text(column)
    return np.frombuffer(data.tobytes(), kind).reshape(len(off) - 1, dim_items)


def _integers(t, dim):
    """The vectors of rows of one length, from items of 4 bytes or, in wide rows, 8."""
    wide = t.column("wide").to_numpy()
    out = np.empty((len(wide), dim), np.int64)
    for some, kind in ((~wide, "<i4"), (wide, "<i8")):
        out[some] = _rows(t.column("z").filter(pa.array(some)), kind, dim)
    return out


def _pairs(data, asked, centres):
    """(block, anchors, their vectors) for each vector length that both sides hold."""
    size = {}
    for name, t in (("data", data), ("asked", asked)):
        size[name] = np.diff(tk.flat_text(t.column("z"))[1]) // np.where(t.column("wide").to_numpy(), 8, 4)
    for dim in np.intersect1d(size["data"], size["asked"]).tolist():
        d, a = data.filter(pa.array(size["data"] == dim)), asked.filter(pa.array(size["asked"] == dim))
        block = Block(d.column("id").to_numpy(), d.column("label").to_numpy(), _integers(d, dim),
                      _rows(d.column("codes"), "<u8", LEVELS * -(-dim // 64)), _rows(d.column("sizes"), "<f8", LEVELS + 1), centres[dim])
        yield block, a, _integers(a, dim)


_EVERY = (-np.inf, np.inf)
_POSITIVES = "akey long, positive_id long, positive_score long"
_NEGATIVES = "akey long, anchor_id long, nth int, positive_id long, positive_score long, negative_id long, negative_score long"


def _table(schema, columns):
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [np.int32 if c.endswith(" int") else np.int64 for c in schema.split(", ")]
    return pa.table({n: np.concatenate([np.zeros(0, k), *[r[i] for r in columns]]).astype(k) for i, (n, k) in enumerate(zip(names, kinds))})


def _find_positives(centres, k):
    def run(key, data, asked):
        out = []
        for block, anchors, vectors in _pairs(data, asked, centres.value):
            akey, own, label = (anchors.column(c).to_numpy() for c in ("akey", "id", "label"))
            for value in np.unique(label):
                part = block.part(*block.span(value))
                same = np.flatnonzero(label == value)
                for at in range(0, len(same), _TOGETHER):
                    some = same[at:at + _TOGETHER]
                    shown = part.ids != own[some][:, None]
                    for a, ((ids, score),) in zip(some, part.search(vectors[some], shown, [[_EVERY]] * len(some), k)):
                        out.append((np.full(len(ids), akey[a]), ids, score))
        return _table(_POSITIVES, out)
    return run


def windows_of(scores, least, most):
    """The whole scores s with least * p <= 100 * s <= most * p, for each positive score p."""
    return [(-(-least * p // 100), most * p // 100) for p in scores]


def _find_negatives(centres, k, least, most):
    def run(key, data, asked):
        out = []
        for block, anchors, vectors in _pairs(data, asked, centres.value):
            akey, own, label = (anchors.column(c).to_numpy() for c in ("akey", "id", "label"))
            open_ = []  # (anchor, its positives with a window that isn't empty, those windows)
            for a, positives in enumerate(anchors.column("positives").to_pylist()):
                windows = zip(positives, windows_of([p["positive_score"] for p in positives], least, most))
                use = [(p, w) for p, w in windows if w[0] <= w[1]]
                if use:
                    open_.append((a, *map(list, zip(*use))))
            for at in range(0, len(open_), _TOGETHER):
                some = open_[at:at + _TOGETHER]
                at_label = label[[a for a, _, _ in some]][:, None]
                shown = (block.ids != own[[a for a, _, _ in some]][:, None]) & (block.labels != at_label)
                found = block.search(vectors[[a for a, _, _ in some]], shown, [w for _, _, w in some], k)
                for (a, positives, _), lists in zip(some, found):
                    for p, (ids, score) in zip(positives, lists):
                        fixed = akey[a], own[a], p["nth"], p["positive_id"], p["positive_score"]
                        out.append([np.full(len(ids), x) for x in fixed] + [ids, score])
        return _table(_NEGATIVES, out)
    return run


def integers(table: DataFrame, id_column: str, label_column: str, vector_column: str, scale: float = 256.0, limit: int = _LIMIT) -> DataFrame:
    """(id, label, z) of the rows that take part; z holds floor(scale * component), at most
    ``limit`` either way (``LONG``: as it is)."""
    z = F.transform(F.col(vector_column), lambda x: F.greatest(F.least(F.floor(x.cast("double") * scale), F.lit(limit)), F.lit(-limit)))
    return (table.filter(F.col(id_column).isNotNull() & F.col(label_column).isNotNull() & whole(F.col(vector_column)))
            .select(F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("long").alias("label"), z.alias("z")))


def means(rows: DataFrame) -> dict[int, np.ndarray]:
    """The mean vector of each vector length: d numbers for length d."""
    sums = (rows.select(F.size("z").alias("dim"), F.posexplode("z").alias("i", "x")).groupBy("dim", "i").agg(F.avg("x").alias("x"))).collect()
    out = {}
    for r in sums:
        out.setdefault(r.dim, np.zeros(r.dim))[r.i] = r.x
    return out


def index(rows: DataFrame, centres) -> DataFrame:
    """(akey, id, label, z, wide, codes, sizes): the rows with their codes; akey names a row's
    content, z's items have 8 bytes in wide rows, which need them, and 4 in others."""
    def run(batches):
        for b in batches:
            z = b.column("z")
            dims = np.diff(z.offsets.to_numpy())
            for dim in np.unique(dims).tolist():
                same = b.filter(pa.array(dims == dim))
                every = same.column("z").flatten().to_numpy().reshape(len(same), dim)
                large = np.abs(every).max(axis=1) >= 1 << 31
                for wide in np.unique(large).tolist():
                    part, m = same.filter(pa.array(large == wide)), every[large == wide].astype(np.int64 if wide else np.int32)
                    codes, sizes = encode(m.astype(float), centres.value[dim])
                    even = lambda a: tk.blobs(a.ravel(), np.arange(len(part) + 1) * a.shape[1])
                    yield pa.RecordBatch.from_arrays([part.column("akey"), part.column("id"), part.column("label"), even(m),
                                                      pa.array(np.full(len(part), wide)), even(codes), even(sizes)],
                                                     names=["akey", "id", "label", "z", "wide", "codes", "sizes"])

    return rows.select(F.xxhash64("id", "label", "z").alias("akey"), "id", "label", "z") \
        .mapInArrow(run, "akey long, id long, label long, z binary, wide boolean, codes binary, sizes binary")


def mine(rows: DataFrame, is_anchor: str, n_positives: int = 5, n_negatives: int = 10, least: int = 30, most: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for every row
    of ``rows`` (id, label, z) that meets ``is_anchor``, each of its ``n_positives`` best rows of
    its label, and the ``n_negatives`` best rows of other labels whose score is ``least`` to
    ``most`` percent of the positive's."""
    spark = rows.sparkSession
    centres = spark.sparkContext.broadcast(means(rows))
    data = tk.stored(index(rows, centres), "codes")
    asked = data.filter(is_anchor).select("akey", "id", "label", "z", "wide").dropDuplicates(["akey"])
    row_bytes = F.octet_length("z") * 2 + F.octet_length("codes") + F.octet_length("sizes") + 24
    size = data.agg(F.sum(row_bytes), F.sum(F.when(F.expr(is_anchor), F.octet_length("z") + 200))).first()
    blocks, q_blocks = tk.parts_for(int(size[0] or 0), _BLOCK_BYTES, _LEAST_BLOCKS), tk.parts_for(int(size[1] or 0), _BLOCK_BYTES, 1)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    data = data.select("id", "label", "z", "wide", "codes", "sizes", F.pmod("akey", F.lit(blocks)).alias("b"), every(q_blocks).alias("qb")).groupBy("b", "qb")

    def tiles(anchors, run, schema):
        anchors = anchors.select("*", F.pmod("akey", F.lit(q_blocks)).alias("qb"), every(blocks).alias("b"))
        return data.cogroup(anchors.groupBy("b", "qb")).applyInArrow(run, schema)

    nth = F.row_number().over(W.partitionBy("akey").orderBy(F.desc("positive_score"), "positive_id"))
    positives = tiles(asked, _find_positives(centres, n_positives), _POSITIVES).withColumn("nth", nth).filter(F.col("nth") <= n_positives)
    # n_positives entries at most
    lists = positives.groupBy("akey").agg(F.collect_list(F.struct("nth", "positive_id", "positive_score")).alias("positives"))
    known = tk.stored(asked.join(lists, "akey"), "positives")
    rank = F.row_number().over(W.partitionBy("akey", "nth").orderBy(F.desc("negative_score"), "negative_id"))
    return (tiles(known, _find_negatives(centres, n_negatives, least, most), _NEGATIVES).withColumn("rank", rank)
            .filter(F.col("rank") <= n_negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = tk.read_table(spark, sf_dir, "embeddings")
    label = F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")
    return mine(integers(table.withColumn("label", label), "vec_id", "label", "embedding", limit=LONG), "id % 100 = 0")


ORACLE_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS z
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_inner_product(a.z, b.z)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.z) = len(b.z)
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)::INTEGER AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""
