"""Near-duplicate groups by exact Jaccard similarity of word shingles, with several global orders.

If two sets are at least ``threshold`` alike, then under *any* order of all tokens their prefixes
share a token; prefixes that are longer by l share l tokens. Orders used here:

* order A, by token hash. Longer prefixes of all documents are counted against each other: a
  document goes on only if enough of its prefix tokens occur in another set's prefix. This drops
  nearly all documents that have no partner, for three tenths of their tokens.
* order C, by frequency among those that go on, rarest first, which makes lists of prefix tokens
  short: a passage that many documents share comes last. Pairs meet in these lists only.
* orders A and B (another hash), which a pair's prefixes must share a token under as well, before
  the sets themselves are compared.

Equal sets are one class from the start. Within a list, pairs with its most central class are
compared first; only classes that are not yet in one component are then compared with each other,
all of them, so no link between components is lost and no group is expanded into all its pairs.

Sets hold 64-bit hashes of shingles; classes are told apart by 128 bits. Cases: a null text is
empty; a document without words has n_shingles 0 and is its own component; fewer words than a
shingle make one shingle of them all; repeated rows are one class; a null doc_id takes part but is
never a component's name, unless the component has no other; further columns are ignored. Rows are
told apart by their place (file and row), not by doc_id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockrisk.llm.components import connected_components
from blockrisk.llm.frames import SCORE_BYTES, TEXT_BATCH, id_and_text, keep_only, shuffle_partitions, slices, split_points, strings_of, with_place, written
from blockrisk.session import settings

WORDS, PERCENT = 5, 80
_MIX = np.uint64(0x9E3779B97F4A7C15)
_ORDER_B = np.uint64(0xD6E8FEB86659FD93)


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """For each text its distinct shingle hashes (unsigned 64 bits) in rising order."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = lists.flatten().dictionary_encode()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    real = pc.greater(pc.binary_length(coded.dictionary), 0).to_numpy(zero_copy_only=False)
    index = coded.indices.to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    keep = real[index]
    flat, owner = hashes[index[keep]], owner[keep]
    at = split_points(np.bincount(owner, minlength=len(lists)))
    rolled = np.zeros(len(flat), np.uint64)
    for k in range(words):
        rolled[: len(flat) - k] = rolled[: len(flat) - k] * _MIX + flat[k:]
    # only the first len - words + 1 values of a text are its shingles; shorter texts are hashed whole
    out = []
    for start, stop in zip(at[:-1].tolist(), at[1:].tolist()):
        if stop - start >= words:
            out.append(np.unique(_finish(rolled[start : stop - words + 1])))
        elif stop > start:
            whole = np.array([stop - start], np.uint64)
            for k in range(start, stop):
                whole = whole * _MIX + flat[k : k + 1]
            out.append(_finish(whole))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def needed(n: int, percent: int = PERCENT) -> int:
    """Tokens that a set of n shares at least with any partner."""
    return -(-n * percent // 100)


def slack(n: int) -> int:
    """Tokens by which prefixes of order A are longer than the least that is right."""
    return n // 10


def _keys(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, file, row, n, print (128 bits of the set), key (64 of them), prefix under order A."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        for batch in batches:
            for part in slices(batch, "text", SCORE_BYTES):
                sets = shingle_sets(strings_of(part.column("text")), words)
                prints = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                prefixes = [s[: len(s) - needed(len(s), percent) + 1 + slack(len(s))] if len(s) else s for s in sets]
                at = split_points(np.array([len(p) for p in prefixes], np.int64)).astype(np.int32)
                flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("doc_id", "file", "row")), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints, pa.binary()), pa.array([int.from_bytes(p[:8], "little", signed=True) if p else None for p in prints], pa.int64()), pa.ListArray.from_arrays(pa.array(at), pa.array(flat.view(np.int64)))],
                    names=["doc_id", "file", "row", "n", "print", "key", "prefix"],
                )

    return docs.mapInArrow(describe, "doc_id long, file long, row long, n long, print binary, key long, prefix array<long>")


def _shared_prefix_counts(keys: DataFrame) -> DataFrame:
    """(key, hits): at least the number of the set's prefix tokens that another set's prefix holds."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, first = np.unique(batch.column("key").to_numpy(zero_copy_only=False), return_index=True)
            prefix = batch.column("prefix").take(pa.array(first))
            token = prefix.flatten().to_numpy(zero_copy_only=False)
            owner = np.repeat(key, pc.list_value_length(prefix).to_numpy(zero_copy_only=False))
            order = np.argsort(token, kind="stable")
            token, owner = token[order], owner[order]
            fresh = np.append(True, token[1:] != token[:-1]) if len(token) else np.zeros(0, bool)
            size = np.diff(np.append(np.where(fresh)[0], len(token)))
            alone = np.repeat(size == 1, size)
            many, hits = np.unique(owner[~alone], return_counts=True)
            # tokens that several sets of this batch hold are sent once, without an owner
            tokens = [token[alone], token[fresh][size > 1], many]
            owners = [owner[alone], np.zeros(int((size > 1).sum()), np.int64), many]
            kinds = [np.zeros(len(tokens[0]), np.int32), np.full(len(tokens[1]), -1, np.int32), hits.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (tokens, owners, kinds)], names=["token", "key", "hits"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches if b.num_rows]
        if not parts:
            return
        token, key, hits = (np.concatenate(x) for x in zip(*parts))
        parts.clear()
        local = hits > 0
        keys, sums = [key[local]], [hits[local]]
        token, key, several = token[~local], key[~local], hits[~local] < 0
        order = np.lexsort((key, several, token))
        token, key, several = token[order], key[order], several[order]
        if len(token):
            same = np.append(False, (token[1:] == token[:-1]) & (key[1:] == key[:-1]) & (several[1:] == several[:-1]))
            token, key, several = token[~same], key[~same], several[~same]
            starts = np.where(np.append(True, token[1:] != token[:-1]))[0]
            weight = np.add.reduceat(np.where(several, 2, 1), starts)
            shared = np.repeat(weight > 1, np.diff(np.append(starts, len(token)))) & ~several
            keys.append(key[shared])
            sums.append(np.ones(int(shared.sum()), np.int32))
        key, sums = _summed(np.concatenate(keys), np.concatenate(sums))
        # a row for each task that sums up keys, not one for each key
        order = np.argsort(key % tasks, kind="stable")
        bounds = np.searchsorted((key % tasks)[order], np.arange(tasks + 1)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(x[order])) for x in (key, sums)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(tasks)), *lists], names=["part", "keys", "sums"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, hits = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in batches:
            more = [b.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("keys", "sums")]
            key, hits = _summed(np.append(key, more[0]), np.append(hits, more[1]))
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(hits)], names=["key", "hits"])

    tasks = shuffle_partitions(keys.sparkSession)
    sent = keys.where("n > 0").select("key", "prefix").mapInArrow(entries, "token long, key long, hits int")
    counted = sent.repartition(tasks, "token").mapInArrow(count, "part long, keys array<long>, sums array<long>")
    return counted.repartition(tasks, "part").mapInArrow(total, "key long, hits long")


def _summed(key: np.ndarray, hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key, back = np.unique(key, return_inverse=True)
    return key, np.bincount(back, hits, len(key)).astype(np.int64)


def _sets_of(docs: DataFrame, wanted: DataFrame, words: int, percent: int) -> DataFrame:
    """class_id, n, tokens (order A), prefix_b of the wanted classes, from their texts."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        for batch in batches:
            for part in slices(batch, "text", SCORE_BYTES):
                sets = shingle_sets(strings_of(part.column("text")), words)
                prefixes = [s[np.argsort(_finish(s * _ORDER_B))[: len(s) - needed(len(s), percent) + 1]] if len(s) else s for s in sets]
                columns = [pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary())]
                for arrays in (sets, prefixes):
                    at = split_points(np.array([len(a) for a in arrays], np.int64)).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(arrays).view(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, names=["print", "tokens", "prefix_b"])

    # a chance collision of places adds a text whose print nobody wants
    texts = docs.select("text", F.xxhash64("file", "row").alias("place")).join(wanted.select(F.col("rep_place").alias("place")), "place", "left_semi")
    built = texts.select("text").mapInArrow(build, "print binary, tokens array<long>, prefix_b array<long>")
    return built.join(wanted.select("print", "class_id", "n"), "print").drop("print").dropDuplicates(["class_id"])


def _prefix_lists(sets: DataFrame, percent: int) -> DataFrame:
    """token, class_id, n, rest, central: the prefixes under order C, without tokens that one set alone holds.

    ``rest`` counts the set's tokens from this one on; tokens that it alone holds come before all others.
    """
    held = sets.select("class_id", "n", F.explode("tokens").alias("token"))
    common = held.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    by_class = held.join(common, "token").groupBy("class_id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("shared"), (F.sum("df") / F.first("n")).alias("central"))
    length = F.col("n") - _needed(F.col("n"), percent) + 1 - (F.col("n") - F.size("shared"))
    kept = by_class.where(length > 0).select("class_id", "n", "central", F.size("shared").alias("size"), F.posexplode(F.slice("shared", F.lit(1), length.cast("int"))).alias("place", "one"))
    return kept.select("class_id", "n", (F.col("size") - F.col("place")).alias("rest"), "central", F.col("one.token").alias("token"))


def _needed(n: Column, percent: int) -> Column:
    return F.floor((n * percent + 99) / 100)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are alike: prefixes of orders A and B first, then the whole sets."""
    side = lambda x: sets.select(*(F.col(c).alias(f"{x}_{c}") for c in ("class_id", "n", "tokens", "prefix_b")))
    both = pairs.join(side("a").withColumnRenamed("a_class_id", "a"), "a").join(side("b").withColumnRenamed("b_class_id", "b"), "b")
    prefix = lambda x: F.slice(f"{x}_tokens", F.lit(1), (F.col(f"{x}_n") - _needed(F.col(f"{x}_n"), percent) + 1).cast("int"))
    passed = both.where(F.arrays_overlap(prefix("a"), prefix("b"))).where(F.arrays_overlap("a_prefix_b", "b_prefix_b"))
    common = F.size(F.array_intersect("a_tokens", "b_tokens"))
    return passed.where(100 * common >= percent * (F.col("a_n") + F.col("b_n") - common)).select("a", "b")


def _may_match(one: str, two: str, percent: int) -> Column:
    """Whether sets (n, rest) that meet in a token, their first common one, can be alike: by size and by what is left."""
    n, m = F.col(f"n{one}"), F.col(f"n{two}")
    common = F.ceil(percent * (n + m) / (100 + percent))
    return (n * 100 >= m * percent) & (m * 100 >= n * percent) & (F.least(f"rest{one}", f"rest{two}") >= common)


def _components(sets: DataFrame, percent: int) -> DataFrame:
    """(class_id, label): the components of all links between classes, for those that have links."""
    lists = written(_prefix_lists(sets, percent), "prefix-lists")
    tops = lists.groupBy("token").agg(F.max(F.struct("central", F.col("class_id").alias("head"), F.col("n").alias("n_head"), F.col("rest").alias("rest_head"))).alias("top"))
    stars = lists.join(tops.select("token", "top.head", "top.n_head", "top.rest_head"), "token").where((F.col("class_id") != F.col("head")) & _may_match("", "_head", percent))
    tried = written(stars.select(F.least("class_id", "head").alias("a"), F.greatest("class_id", "head").alias("b")).distinct(), "star-pairs")
    links = written(_verified(tried, sets, percent), "star-links")
    labels = connected_components(links).withColumnRenamed("node", "class_id")
    labelled = lists.drop("central").join(labels, "class_id", "left").withColumn("label", F.coalesce("label", "class_id"))
    labelled = written(labelled, "labelled-lists")
    mixed = labelled.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select("token")
    rest = labelled.join(mixed, "token")
    one, two = (rest.select("token", *(F.col(c).alias(f"{c}_{x}") for c in ("class_id", "n", "rest", "label"))) for x in "ab")
    across = one.join(two, "token").where((F.col("label_a") < F.col("label_b")) & _may_match("_a", "_b", percent))
    across = across.select(F.least("class_id_a", "class_id_b").alias("a"), F.greatest("class_id_a", "class_id_b").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
    more = written(_verified(across, sets, percent), "links-across")
    return _joined(labels, more)


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (class_id, label) after further links: only the components that these touch are labelled again."""
    if links.isEmpty():
        return labels
    name = lambda x: labels.select(F.col("class_id").alias(x), F.col("label").alias(f"label_{x}"))
    between = links.join(name("a"), "a", "left").join(name("b"), "b", "left")
    between = between.select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b"))
    over = connected_components(between)
    known = labels.unionByName(over.select(F.col("node").alias("class_id"), F.col("node").alias("label"))).distinct()
    tops = over.select(F.col("node").alias("label"), F.col("label").alias("top"))
    return known.join(tops, "label", "left").select("class_id", F.coalesce("top", "label").alias("label"))


def _grouped(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The rows with words (doc_id, file, row, n, label, component_id) and those without (doc_id, file, row, n)."""
    placed, file, row = with_place(docs)
    rows = id_and_text(placed, further={file: "file", row: "row"})
    with settings(docs.sparkSession, TEXT_BATCH):
        keys = written(_keys(rows, words, percent), "shingle-keys")
    least = (F.min("doc_id").alias("rep_doc"), F.min(F.xxhash64("file", "row")).alias("rep_place"))
    classes = keys.where("n > 0").groupBy("print").agg(F.first("key").alias("key"), F.first("n").alias("n"), *least)
    classes = written(classes.withColumn("class_id", F.monotonically_increasing_id()), "classes")
    enough = F.greatest(F.lit(1), F.floor(_needed(F.col("n"), percent) / 10))
    wanted = classes.join(_shared_prefix_counts(keys), "key").where((F.col("hits") >= enough)).select("print", "class_id", "n", "rep_place")
    wanted = written(wanted, "with-partners")
    with settings(docs.sparkSession, TEXT_BATCH):
        sets = written(_sets_of(rows, wanted, words, percent), "sets")
    labels = _components(sets, percent)
    named = classes.join(labels, "class_id", "left").select("print", "rep_doc", F.coalesce("label", "class_id").alias("label"))
    names = named.groupBy("label").agg(F.min("rep_doc").alias("component_id"))
    by_print = named.join(names, "label").select("print", "label", "component_id")
    parts = keys.select("doc_id", "file", "row", "n", "print")
    return parts.where("n > 0").join(by_print, "print").drop("print"), parts.where("n = 0").drop("print")


def near_duplicate_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id that links reach): one row per row of ``docs``."""
    grouped, empty = _grouped(docs, words, percent)
    size = F.col("n").alias("n_shingles")
    return grouped.select("doc_id", size, "component_id").unionByName(empty.select("doc_id", size, F.col("doc_id").alias("component_id")))


def keep_first_of_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, with all their columns, one per component: the one of the least doc_id, null last, then by place."""
    placed, file, row = with_place(docs)
    names = [f"`{n}`" for n in docs.columns]
    grouped, empty = _grouped(placed.select(*names), words, percent)
    first = grouped.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "file", "row")).alias("first"))
    kept = first.select("first.file", "first.row").unionByName(empty.select("file", "row"))
    return placed.join(kept.select(F.col("file").alias(file), F.col("row").alias(row)), [file, row], "left_semi").select(*names)
