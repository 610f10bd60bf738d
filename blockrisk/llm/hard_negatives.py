"""Hard negatives by exact search that prunes on coordinates within buckets of like length.

Vectors are sorted by length into buckets, and every bucket keeps one sorted list per coordinate of
its vectors scaled to length one. A search that needs a score of ``t`` from a query of length ``q``
skips a bucket whose longest vector cannot reach it, and so all shorter ones. Else the angle between
the two is at most that of cosine ``c = t / (q * longest)``, so the vector lies in a cap around the
query, and in each coordinate within a feasible range: from ``u*c - s`` to ``u*c + s`` with ``u`` the
query's own coordinate and ``s = sqrt((1 - u*u) * (1 - c*c))``, or to the pole if that is in the cap.
The query's largest coordinates are its focus: their ranges are found in the sorted lists by binary
search, the row sets are intersected, and only what is left is verified by the exact integer inner
product. ``t`` rises as results fill, so later buckets are pruned harder.

Positives are searched among rows of the anchor's label: rows and anchors are dealt by label, a
large label over as many shards as it needs. Negatives are searched in the score window that each
positive opens, among all rows, dealt by band of length and hash; an anchor is not sent to bands too
short for its window. A task holds one shard and one block of anchors, both of bounded size.
Results are exact: no row is left out but by a bound that proves it.

Cases: rows whose label or vector is null, or that hold a null, NaN or infinite component, take no
part. Vectors of different length count as zero where they end, so an empty one scores 0. Every row
counts, repeated ones too: a row is never its own positive, but a copy of it is; an anchor that is
there twice is answered twice, positives alike are each a positive. A null id is no anchor, but may
be a positive or negative; it comes last among ties, as rows alike in score and id come in order of
file and row. A positive of negative score has no negatives, as its window is empty. An empty table,
or one without anchors, gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blockrisk.llm.frames import placed, written
from blockrisk.llm.maxscore import _matrix, integer_weights

SHARD_ROWS, BLOCK_ANCHORS, BUCKET_ROWS = 8192, 4096, 2048
#: Coordinates whose sorted lists are searched, the query's largest first.
FOCUS = 4
#: Bounds are loosened by this share against rounding, so that no row in reach is lost.
SLACK = 1e-9
#: Bands of length: this many to each doubling.
BANDS = 8
LAST_ID = np.iinfo(np.int64).max
POSITIVES = "anchor_file long, anchor_row long, anchor_id long, vec_id long, file long, row long, score long"
NEGATIVES = "anchor_file long, anchor_row long, high long, vec_id long, file long, row long, score long"


class Bucket:
    """Rows ``first`` to ``last`` of a length-sorted matrix, with a sorted list per coordinate."""

    def __init__(self, unit: np.ndarray, lengths: np.ndarray, first: int, last: int):
        self.first, self.rows, self.longest = first, last - first, float(lengths[first])
        self.unit = unit[first:last]
        self.order = np.argsort(self.unit, axis=0, kind="stable").T.copy()
        self.lists = np.take_along_axis(self.unit, self.order.T, axis=0).T.copy()

    def within(self, query: np.ndarray, cosine: float) -> np.ndarray:
        """Numbers of the rows that every focus coordinate's feasible range holds."""
        everything = np.arange(self.first, self.first + self.rows)
        if cosine <= SLACK:
            return everything
        cosine = min(cosine, 1.0)
        focus = np.argsort(-np.abs(query))[:FOCUS]
        own = query[focus]
        reach = np.sqrt(np.maximum((1 - own * own) * (1 - cosine * cosine), 0))
        low = np.where(-own >= cosine, -1.0, own * cosine - reach) - SLACK
        high = np.where(own >= cosine, 1.0, own * cosine + reach) + SLACK
        ends = [(np.searchsorted(self.lists[f], a, "left"), np.searchsorted(self.lists[f], b, "right")) for f, a, b in zip(focus, low, high)]
        sizes = [b - a for a, b in ends]
        if min(sizes) == self.rows:
            return everything
        pick = int(np.argmin(sizes))
        rows = self.order[focus[pick], slice(*ends[pick])]
        for k, f in enumerate(focus):
            if k != pick and sizes[k] < self.rows and len(rows):
                values = self.unit[rows, f]
                rows = rows[(values >= low[k]) & (values <= high[k])]
        return rows + self.first


class Buckets:
    """Length-sorted rows in buckets; ``search`` gives the best rows of score windows."""

    def __init__(self, weights: np.ndarray, bucket_rows: int = BUCKET_ROWS):
        real = weights.astype(np.float64)
        lengths = np.sqrt((real * real).sum(1))
        self.order = np.argsort(-lengths, kind="stable")
        self.weights, lengths = weights[self.order], lengths[self.order]
        unit = real[self.order] / np.maximum(lengths, 1e-300)[:, None]
        cuts = range(0, len(lengths), bucket_rows)
        self.buckets = [Bucket(unit, lengths, a, min(a + bucket_rows, len(lengths))) for a in cuts]
        self.tested = 0

    def search(self, query: np.ndarray, allowed: np.ndarray, ties: np.ndarray, lows: np.ndarray, highs: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window [low, high] of scores: (rows, scores) of its k best allowed rows, ties by ``ties``.

        ``allowed`` and ``ties`` are in sorted order, as are the row numbers returned.
        """
        best = [(np.zeros(0, np.int64), np.zeros(0, self.weights.dtype))] * len(lows)
        least = lows.astype(np.float64)
        real = query.astype(np.float64)
        size = math.sqrt(float(real @ real))
        unit = real / max(size, 1e-300)
        for bucket in self.buckets:
            need, top = float(least.min()), size * bucket.longest
            if need > 0 and need > top * (1 + SLACK):
                break
            rows = bucket.within(unit, need / (top * (1 + SLACK)) if need > 0 else 0.0)
            rows = rows[allowed[rows]]
            if not len(rows):
                continue
            self.tested += len(rows)
            score = self.weights[rows] @ query
            for w in range(len(lows)):
                inside = (score >= least[w]) & (score <= highs[w])
                if not inside.any():
                    continue
                of, value = np.concatenate([best[w][0], rows[inside]]), np.concatenate([best[w][1], score[inside]])
                if len(of) > 16 * k:
                    near = np.where(value >= np.partition(value, -k)[-k])[0]
                    of, value = of[near], value[near]
                keep = np.lexsort((ties[of], -value))[:k]
                best[w] = of[keep], value[keep]
                if len(keep) == k:
                    least[w] = max(least[w], float(best[w][1][-1]))
        return best


def _shard(table: pa.Table) -> dict:
    """Columns of a group as arrays: ids with their null marks, rows of candidates and of anchors, weights."""
    table = table.combine_chunks()
    one = lambda name: table.column(name).combine_chunks() if isinstance(table.column(name), pa.ChunkedArray) else table.column(name)
    ids = one("vec_id")
    lists = one("weights")
    terms = max(1, int(np.max(lists.value_lengths().to_numpy(zero_copy_only=False), initial=0)))
    matrix = _matrix(lists, terms)
    peak = np.abs(matrix.astype(np.float64)).max(0)
    if float((peak * peak).sum()) < 2.0**52:  # sums of products are then exact in floating point
        matrix = matrix.astype(np.float64)
    return {
        "id": ids.fill_null(LAST_ID).to_numpy(), "no_id": ids.is_null().to_numpy(zero_copy_only=False), "file": one("file").to_numpy(), "row": one("row").to_numpy(),
        "label": one("label").dictionary_encode().indices.to_numpy(zero_copy_only=False), "matrix": matrix,
        "asks": one("asks").to_numpy(zero_copy_only=False), "highs": one("highs"),
    }


def _answers(columns: dict, same: bool, k: int, share: float, bucket_rows: int) -> Iterator[tuple]:
    """(anchor's place in the group, window's end, rows found, scores) for every anchor of the group."""
    anchors, others = np.where(columns["asks"])[0], np.where(~columns["asks"])[0]
    # order among ties: by id, missing ones last, then by place
    others = others[np.lexsort((columns["row"][others], columns["file"][others], columns["no_id"][others], columns["id"][others]))]
    index = Buckets(columns["matrix"][others], bucket_rows)
    ties, of = index.order, others[index.order]
    label, file, row = (columns[name][of] for name in ("label", "file", "row"))
    for anchor in anchors.tolist():
        allowed = label == columns["label"][anchor] if same else label != columns["label"][anchor]
        if same:
            allowed &= (file != columns["file"][anchor]) | (row != columns["row"][anchor])
            lows, highs = np.array([-np.inf]), np.array([np.inf])
        else:
            highs = np.array(columns["highs"][anchor].as_py(), np.int64)
            lows = -((-highs * int(round(share * 100))) // 100)  # rounded up, as scores are whole
        for high, (rows, scores) in zip(highs.tolist(), index.search(columns["matrix"][anchor], allowed, ties, lows, highs, k)):
            yield anchor, high, of[rows], scores.astype(np.int64)


def _searcher(same: bool, k: int, share: float, bucket_rows: int):
    names = [f.split()[0] for f in (POSITIVES if same else NEGATIVES).split(", ")]

    def search(table: pa.Table) -> pa.Table:
        columns = _shard(table)
        found = [a for a in _answers(columns, same, k, share, bucket_rows) if len(a[2])]
        anchors = np.repeat(np.array([a[0] for a in found], np.int64), [len(a[2]) for a in found])
        rows = np.concatenate([a[2] for a in found]) if found else np.zeros(0, np.int64)
        scores = np.concatenate([a[3] for a in found]) if found else np.zeros(0, np.int64)
        ends = columns["id"][anchors] if same else np.repeat(np.array([a[1] for a in found], np.int64), [len(a[2]) for a in found])
        out = [pa.array(columns["file"][anchors]), pa.array(columns["row"][anchors]), pa.array(ends, pa.int64()), pa.array(columns["id"][rows], mask=columns["no_id"][rows])]
        return pa.table([*out, pa.array(columns["file"][rows]), pa.array(columns["row"][rows]), pa.array(scores)], names=names)

    return search


def _dealt(parts: Column) -> Column:
    return F.pmod(F.xxhash64("row", "file"), parts).cast("int")


def _every(parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), (parts - 1).cast("int")))


def _first(found: DataFrame, within: list[str], k: int) -> DataFrame:
    """The k best of each group, merged over shards, with their ``rank``."""
    order = [F.desc("score"), F.asc_nulls_last("vec_id"), "file", "row"]
    rank = F.row_number().over(Window.partitionBy(*within).orderBy(*order))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


_SIDE = ["vec_id", "label", "weights", "file", "row"]
_NO_WINDOW = "cast(null as array<long>) AS highs"


def positives(rows: DataFrame, k: int = 5, shard_rows: int = SHARD_ROWS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """For each anchor of ``rows`` (see ``usable_rows``) its k best other rows of the same label."""
    sizes = rows.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_anchor").alias("asking")).where("asking > 0")
    sizes = sizes.select("label", F.ceil(F.col("n") / shard_rows).alias("shards"), F.ceil(F.col("asking") / BLOCK_ANCHORS).alias("blocks"))
    sized = rows.join(sizes, "label")
    left = sized.select(*_SIDE, F.lit(False).alias("asks"), F.expr(_NO_WINDOW), _dealt(F.col("shards")).alias("shard"), _every(F.col("blocks")).alias("block"))
    right = sized.where("is_anchor").select(*_SIDE, F.lit(True).alias("asks"), F.expr(_NO_WINDOW), _every(F.col("shards")).alias("shard"), _dealt(F.col("blocks")).alias("block"))
    found = left.unionByName(right).groupBy("label", "shard", "block").applyInArrow(_searcher(True, k, 0.0, bucket_rows), POSITIVES)
    return _first(found, ["anchor_file", "anchor_row"], k)


def negatives(rows: DataFrame, windows: DataFrame, k: int = 5, share: float = 0.8, shard_rows: int = SHARD_ROWS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """For each window (anchor_file, anchor_row, high) the k best rows of another label within ``share * high`` to ``high``."""
    length = F.sqrt(F.aggregate("weights", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x))
    band = F.when(F.col("length") > 0, F.floor(F.log2("length") * BANDS)).otherwise(-1).cast("int")
    rows = rows.withColumn("length", length).withColumn("band", band)
    # one row per band of length: a few hundred, whatever the table holds
    sizes = rows.groupBy("band").agg(F.count("*").alias("n"), F.max("length").alias("longest")).collect()
    if not sizes:
        return rows.sparkSession.createDataFrame([], NEGATIVES + ", rank int")
    shards = {s.band: math.ceil(s.n / shard_rows) for s in sizes}
    parts = F.create_map(*[F.lit(x) for pair in shards.items() for x in pair])
    cells = F.array(*[F.struct(F.lit(s.band).alias("band"), F.lit(s.longest).alias("longest"), F.lit(shards[s.band]).alias("shards")) for s in sizes])
    # an anchor's place, with the ends of its windows: as many as it has positives, at most
    asking = windows.where("high >= 0").groupBy(F.col("anchor_file").alias("file"), F.col("anchor_row").alias("row")).agg(F.sort_array(F.collect_set("high")).alias("highs"))
    asking = written(rows.where("is_anchor").join(asking, ["file", "row"]), "anchors")
    blocks = F.lit(max(1, math.ceil(asking.count() / BLOCK_ANCHORS)))
    left = rows.select(*_SIDE, F.lit(False).alias("asks"), F.expr(_NO_WINDOW), "band", _dealt(parts[F.col("band")]).alias("shard"), _every(blocks).alias("block"))
    reachable = F.filter(cells, lambda c: F.col("length") * c["longest"] * (1 + SLACK) >= F.col("highs")[0] * share)
    sent = asking.select(*_SIDE, "highs", F.explode(reachable).alias("cell"), _dealt(blocks).alias("block"))
    right = sent.select(*_SIDE, F.lit(True).alias("asks"), "highs", F.col("cell.band").alias("band"), _every(F.col("cell.shards")).alias("shard"), "block")
    found = left.unionByName(right).groupBy("band", "shard", "block").applyInArrow(_searcher(False, k, share, bucket_rows), NEGATIVES)
    return _first(found, ["anchor_file", "anchor_row", "high"], k)


def usable_rows(table: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id, label, weights, is_anchor, file, row of the rows that take part, stored."""
    vector = F.col(f"`{vector_col}`")
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(math.inf))
    good = table.where(vector.isNotNull() & label.isNotNull() & ~F.exists(vector, bad))
    own = F.col(f"`{id_col}`").cast("long")
    asks = F.coalesce(is_anchor, F.lit(False)) & own.isNotNull()
    rows = placed(good, {"vec_id": own, "label": label.cast("string"), "weights": integer_weights(vector, scale), "is_anchor": asks})
    return written(rows, "vectors")


def mine(
    table: DataFrame, is_anchor: Column, label: Column, n_positives: int = 5, k: int = 5, share: float = 0.8, id_col: str = "vec_id", vector_col: str = "embedding",
    scale: int = 256, shard_rows: int = SHARD_ROWS, bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Of each anchor and each of its best rows of the same label, the k best rows of another label that
    score at least ``share`` of the positive and no more than it. ``share`` counts in hundredths.
    """
    rows = usable_rows(table, is_anchor, label, id_col, vector_col, scale)
    near = written(positives(rows, n_positives, shard_rows, bucket_rows), "positives")
    windows = near.select("anchor_file", "anchor_row", F.col("score").alias("high"))
    far = negatives(rows, windows, k, share, shard_rows, bucket_rows)
    far = far.select("anchor_file", "anchor_row", "high", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    near = near.select("anchor_file", "anchor_row", "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("high"))
    return near.join(far, ["anchor_file", "anchor_row", "high"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", F.col("high").alias("positive_score"), "negative_score"
    )
