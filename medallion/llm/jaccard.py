"""N-gram Jaccard join (op 1) with count-vector R-trees.

A document's set is its distinct 5-word shingles. Documents with equal sets are
one class, compared once. Each class has a point: how many of its shingles
fall into each of ``GROUPS`` hash groups. The overlap of two sets is at most
the sum of the smaller count of each group, and for two boxes of points at most
the sum of the smaller upper corners; pairs, and pairs of whole R-tree nodes,
whose bound is below the overlap that the threshold asks for are dropped, and
what survives is verified on the two texts.

An R-tree alone would have to compare all classes, since boxes in many
dimensions overlap. So points first meet by shingle. From each class the
``SKETCH`` shingles with the smallest hashes are taken; sets that link share
at least ``SHARED`` of them (all linked pairs of sets of 36 and fewer shingles;
of larger ones, all but a chance of 5e-13 each, that of the binomial tail).
Hence of the sketch, ordered from rare to frequent over the whole corpus, the
last ``SHARED`` - 1 can be left out, as in prefix filtering: a passage that a
third of all documents share is no meeting place unless it makes up a quarter
of a document.

1. Classes that meet at a shingle are compared with the least class that meets
   there: two grouped minima and an equi-join, a row per meeting. The verified links
   give provisional components.
2. Only shingles where several components still meet go on. Their classes are
   cut into blocks of ``BLOCK`` at most, pairs of blocks are joined with R-trees of
   the count points, and pairs across components verified. So near copies by the
   thousand, one component since step 1, are never paired among themselves.
3. Only where links are asked for: a linked pair is in one component, so the
   classes of each component of three and more are cut into blocks, and pairs
   of blocks bounded by R-trees and verified in place. Out come numbers of links
   by class, not the pairs. Components of two need no more than step 1 or 2.

Results are whole: no class, shingle or partner is capped. Null or wordless
text: empty set, linked with nothing. Null ids: a component's id is the least
that isn't null. Repeated rows are copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm import _hashing as H
from medallion.llm._blocks import configure, map_blocks, written
from medallion.llm._components import components

WIDTH = 5
THRESHOLD = (75, 100)
GROUPS = 256
SKETCH = 48
SHARED = 13  # P(binomial(48, 0.75) < 13) is 5e-13
BLOCK = 256
LEAF = 16
SMALL = 48  # cells without a tree: three leaves or less on a side
BLOCK_BYTES = 1 << 20
BLOCK_SHINGLES = 1 << 20  # of a block whose pairs are verified in place, unless one text has more
COLUMNS = 4096


def shingles(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    buffer, begin = H.joined(texts)
    _, _, word, first = H.words(buffer, begin, lower=True)
    grams = H.word_grams(word, width)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            yield np.unique(grams[a : b - width + 1])
        elif b > a:
            yield H.mix(H.word_grams(word[a:b], b - a) + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


def _sets(width: int):
    def each(block):
        n, one, two, sketch, point = [], [], [], [], []
        for s in shingles([(t or "").encode() for t in block.column("_text").to_pylist()], width):
            n.append(len(s))
            one.append(int(s.sum(dtype=np.uint64).view(np.int64)))
            two.append(int(H.mix(s).sum(dtype=np.uint64).view(np.int64)))
            sketch.append(s[:SKETCH].view(np.int64))
            point.append(np.bincount((s >> np.uint64(7)).astype(np.int64) % GROUPS, minlength=GROUPS).astype("<i4").tobytes())
        names = [c for c in block.schema.names if c != "_text"]
        yield pa.RecordBatch.from_arrays(
            [*(block.column(c) for c in names), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(sketch, pa.list_(pa.int64())), pa.array(point, pa.binary())],
            [*names, "n_shingles", "_one", "_two", "_sketch", "_point"],
        )

    return each


def needed(a, b):
    """Least overlap of linked sets of sizes a and b: 100 o >= 75 (a + b - o)."""
    p, q = THRESHOLD
    return -(-(a + b) * p // (p + q))


def _verify(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Those of the pairs (a, b) of classes whose texts link."""
    t = texts.select("_class", "_text")
    both = pairs.join(t.select(F.col("_class").alias("b"), F.col("_text").alias("_b")), "b")
    both = both.join(t.select(F.col("_class").alias("a"), F.col("_text").alias("_a")), "a").select("a", "b", "_a", "_b")

    def each(block):
        left = shingles([x.encode() for x in block.column("_a").to_pylist()], width)
        right = shingles([x.encode() for x in block.column("_b").to_pylist()], width)
        p, q = THRESHOLD
        good = []
        for x, y in zip(left, right):
            both = len(np.intersect1d(x, y, assume_unique=True))
            good.append(q * both >= p * (len(x) + len(y) - both) and both > 0)
        yield block.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return map_blocks(both, "_a", BLOCK_BYTES, lambda: each, "a long, b long")


def _tree(points: np.ndarray, size: np.ndarray, root: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Leaves of a packed R-tree, their upper corners, least sizes and roots.

    Sort-tile packing: by size first, then within slices by the widest
    coordinate. Components with enough members to fill a leaf get leaves of
    their own; 0 stands for the root of mixed leaves.
    """
    names, own, members = np.unique(root, return_inverse=True, return_counts=True)
    whole = members >= LEAF
    tree = np.where(whole[own], own + 1, 0)
    leaves, roots = [], []
    for t in np.unique(tree):
        part = np.flatnonzero(tree == t)
        part = part[np.argsort(size[part], kind="stable")]
        for at in range(0, len(part), 8 * LEAF):
            tile = part[at : at + 8 * LEAF]
            wide = int(np.argmax(points[tile].std(0)))
            tile = tile[np.argsort(points[tile, wide], kind="stable")]
            cut = [tile[k : k + LEAF] for k in range(0, len(tile), LEAF)]
            leaves += cut
            roots += [names[t - 1] if t else 0] * len(cut)
    upper = np.stack([points[x].max(0) for x in leaves])
    return leaves, upper, np.array([size[x].min() for x in leaves]), np.array(roots, np.int64)


def _cross(left: np.ndarray, right: np.ndarray, left_root: np.ndarray, right_root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of unequal roots whose bound allows a link: nodes first, then points."""
    left_size, right_size = left.sum(1, dtype=np.int64), right.sum(1, dtype=np.int64)
    if len(left) <= SMALL and len(right) <= SMALL:
        near = np.minimum(left[:, None], right[None]).sum(2) >= needed(left_size[:, None], right_size[None])
        return np.nonzero(near & (left_root[:, None] != right_root[None]))
    a_leaf, a_upper, a_least, a_root = _tree(left, left_size, left_root)
    b_leaf, b_upper, b_least, b_root = _tree(right, right_size, right_root)
    out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i, leaf in enumerate(a_leaf):
        open_ = np.minimum(a_upper[i], b_upper).sum(1) >= needed(a_least[i], b_least)
        if a_root[i]:
            open_ &= b_root != a_root[i]
        if not open_.any():
            continue
        other = np.concatenate([b_leaf[j] for j in np.flatnonzero(open_)])
        for a in leaf:
            # sizes first: they are within 4/3 of each other
            b = other[(right_root[other] != left_root[a]) & (np.minimum(right_size[other], left_size[a]) >= needed(right_size[other], left_size[a]))]
            b = b[np.minimum(right[b], left[a]).sum(1) >= needed(right_size[b], left_size[a])]
            out_a.append(np.full(len(b), a))
            out_b.append(b)
    return np.concatenate(out_a), np.concatenate(out_b)


def _join_cell(table: pa.Table) -> pa.Table:
    """Pairs across components of one pair of blocks (at most 2 ``BLOCK`` rows or so),
    each in the cells of the least shingle that both go by."""
    cls = table.column("_class").to_numpy()
    root = table.column("root").to_numpy()
    block = table.column("_block").to_numpy()
    points = np.frombuffer(b"".join(table.column("_point").to_pylist()), "<i4").reshape(-1, GROUPS)
    points = points.astype(np.uint16) if points.max() < 1 << 16 else points
    i, j, tok = (table.column(c)[0].as_py() for c in ("_i", "_j", "tok"))
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    a, b = _cross(points[left], points[right], root[left], root[right]) if len(left) and len(right) else (left[:0], right[:0])
    a, b = left[a], right[b]
    keep = (cls[a] < cls[b]) | (i != j)
    a, b = a[keep], b[keep]
    if len(a):
        lesser = [np.array([t for t in x if t < tok], np.int64) for x in table.column("toks").to_pylist()]
        own = np.zeros((len(lesser), max(1, max(map(len, lesser)))), np.int64)
        held = np.zeros(own.shape, bool)
        for r, x in enumerate(lesser):
            own[r, : len(x)], held[r, : len(x)] = x, True
        once = np.ones(len(a), bool)
        for c in range(own.shape[1]):
            once &= ~((own[b] == own[a, c][:, None]) & held[b] & held[a, c][:, None]).any(1)
        a, b = a[once], b[once]
    a, b = cls[a], cls[b]
    return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})


def _overlaps(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Shingles that the sets a[k] and b[k] share, for each k: products of 0/1
    matrices over the shingles that two sets or more hold, some columns at a time."""
    rows, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, x = np.unique(at[: len(a)], return_inverse=True)
    right, y = np.unique(at[len(a) :], return_inverse=True)
    _, token, held = np.unique(np.concatenate([sets[r] for r in rows]), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(rows)), [len(sets[r]) for r in rows])
    met = held[token] > 1
    owner, token = owner[met], (np.cumsum(held > 1) - 1)[token[met]]
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    both = np.zeros((len(left), len(right)))
    for c in range(0, int(token[-1]) + 1 if len(token) else 0, COLUMNS):
        p, q = np.searchsorted(token, [c, c + COLUMNS])
        m = np.zeros((len(rows), COLUMNS), np.float32)
        m[owner[p:q], token[p:q] - c] = 1
        both += m[left] @ m[right].T
    return both[x, y].astype(np.int64)


def _count_cell(width: int):
    """Numbers of links (rows of linked classes) by class that one pair of blocks of a component adds."""

    def run(table: pa.Table) -> pa.Table:
        cls, copies, block = (table.column(c).to_numpy() for c in ("_class", "_copies", "_block"))
        sets = list(shingles([x.encode() for x in table.column("_text").to_pylist()], width))
        size = np.array([len(s) for s in sets])
        points = np.stack([np.bincount((s >> np.uint64(7)).astype(np.int64) % GROUPS, minlength=GROUPS) for s in sets]).astype("<i4")
        points = points.astype(np.uint16) if points.max() < 1 << 16 else points
        i, j = (table.column(c)[0].as_py() for c in ("_i", "_j"))
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        n = np.zeros(len(cls), np.int64)
        if len(left) and len(right):
            # roots that differ: every pair counts
            a, b = _cross(points[left], points[right], np.full(len(left), 1), np.full(len(right), 2))
            a, b = left[a], right[b]
            keep = (cls[a] < cls[b]) | (i != j)
            a, b = a[keep], b[keep]
            if len(a):
                p, q = THRESHOLD
                both = _overlaps(sets, a, b)
                good = (q * both >= p * (size[a] + size[b] - both)) & (both > 0)
                np.add.at(n, a[good], copies[b[good]])
                np.add.at(n, b[good], copies[a[good]])
        return pa.table({"_class": pa.array(cls[n > 0], pa.int64()), "n": pa.array(n[n > 0], pa.int64())})

    return run


def _link_counts(by_class: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """(_class, n): rows of other classes that link with a class, of components of three classes or more."""
    blocks = F.greatest(F.ceil(F.col("_classes") / BLOCK), F.ceil(F.col("_shingles") / BLOCK_SHINGLES)).cast("int")
    cells = by_class.where("_classes > 2").select("_class", "root", "_copies", blocks.alias("nb"))
    cells = texts.join(cells.hint("shuffle_hash"), "_class").withColumn("_block", F.pmod(F.xxhash64("_class"), F.col("nb")).cast("int"))
    cells = cells.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    cells = cells.select("root", F.least("_block", "_other").alias("_i"), F.greatest("_block", "_other").alias("_j"), "_block", "_class", "_copies", "_text")
    found = cells.groupBy("root", "_i", "_j").applyInArrow(_count_cell(width), "_class long, n long")
    return found.groupBy("_class").agg(F.sum("n").alias("n"))


def row_key(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(doc_id.cast("long"), F.coalesce(text, F.lit("")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = WIDTH, links: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id, _root, _row) of each row of ``docs``; equal
    ``_root`` tells one component, ``_row`` (``row_key``) rows with other ids or texts apart.
    With ``links`` also n_links: how many other rows each links with, copies too."""
    configure(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = rows.withColumn("_row", row_key(F.col("doc_id"), F.col("_text")))
    sets = written(
        map_blocks(rows, "_text", BLOCK_BYTES, lambda: _sets(width), "doc_id long, _row long, n_shingles long, _one long, _two long, _sketch array<long>, _point binary")
        .withColumn("_class", F.xxhash64("_one", "_two", "n_shingles")),
        "shingle-sets",
    )
    full = sets.where("n_shingles > 0")
    # one row of each class; its sketch and point follow by the row's own key
    heads = full.groupBy("_class").agg(F.min("_row").alias("_row"))
    classes = full.join(heads, ["_class", "_row"]).dropDuplicates(["_class"])
    classes = written(classes.select("_class", "_row", "n_shingles", "_sketch", "_point"), "shingle-classes")

    meet = classes.select("_class", F.explode("_sketch").alias("tok"))
    count = meet.groupBy("tok").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = meet.join(count, "tok").groupBy("_class").agg(F.sort_array(F.collect_list(F.struct("df", "tok"))).alias("t"))  # SKETCH at most
    n = F.col("n_shingles")
    size = F.least(n, F.lit(SKETCH))
    prefix = F.when(4 * n <= 3 * SKETCH, n - F.ceil(n * THRESHOLD[0] / THRESHOLD[1]) + 1).otherwise(size - SHARED + 1)
    left = (prefix - (size - F.size("t"))).cast("int")  # rare ones that nobody shares come first
    meeting = (
        classes.select("_class", "_row", "n_shingles", "_point").join(shared, "_class")
        .where(left > 0)
        # how many others hold its shingles: the text that copies were made from comes before the copies
        .withColumn("rank", F.aggregate("t", F.lit(0.0), lambda s, x: s + F.log2(x["df"])))
        .withColumn("toks", F.sort_array(F.transform(F.slice("t", F.lit(1), F.greatest(F.lit(1), left)), lambda x: x["tok"])))
    )
    meeting = written(meeting.select("_class", "_row", "rank", "toks", "_point"), "meetings")
    meet = meeting.select("_class", "rank", F.explode("toks").alias("tok"))
    points = meeting.select("_class", "_point")
    # the texts of the classes that meet anyone, one of each: repeated rows share a key, and lie together by it
    texts = rows.select("_row", "_text").join(meeting.select("_class", "_row").hint("shuffle_hash"), "_row").dropDuplicates(["_row"])
    texts = written(texts.select("_class", "_text"), "meeting-texts")

    def close(pairs: DataFrame) -> DataFrame:
        """Pairs whose count points allow a link."""
        p = pairs.join(points.select(F.col("_class").alias("a"), F.col("_point").alias("_pa")), "a")
        p = p.join(points.select(F.col("_class").alias("b"), F.col("_point").alias("_pb")), "b")

        def run(batches):
            for t in batches:
                if t.num_rows:
                    x, y = (np.frombuffer(b"".join(t.column(c).to_pylist()), "<i4").reshape(-1, GROUPS) for c in ("_pa", "_pb"))
                    good = np.minimum(x, y).sum(1) >= needed(x.sum(1, dtype=np.int64), y.sum(1, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays([t.column("a"), t.column("b")], ["a", "b"]).filter(pa.array(good))

        return p.select("a", "b", "_pa", "_pb").mapInArrow(run, "a long, b long")

    first = meet.groupBy("tok").agg(F.max(F.struct("rank", "_class"))["_class"].alias("a"))
    stars = meet.join(first, "tok").where("_class <> a").select(F.least("a", "_class").alias("a"), F.greatest("a", "_class").alias("b")).distinct()
    links1 = written(_verify(close(stars), texts, width), "links")
    roots = written(components(links1), "roots")

    rooted = meet.join(roots.withColumnRenamed("vertex", "_class"), "_class", "left").withColumn("root", F.coalesce("root", "_class"))
    rooted = written(rooted, "rooted")
    members = F.sum(F.xxhash64("_class").cast("decimal(38,0)")).alias("members")
    open_ = rooted.groupBy("tok").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("n"), members).where("lo <> hi")
    # shingles where the same classes meet give the same pairs: the least stands for them
    open_ = open_.groupBy("n", "members").agg(F.min("tok").alias("tok"))
    cells = rooted.join(open_.select("tok", F.ceil(F.col("n") / BLOCK).cast("int").alias("nb")), "tok")
    cells = cells.withColumn("_block", F.pmod(F.xxhash64("_class"), F.col("nb")).cast("int"))
    cells = cells.join(meeting.select("_class", "toks", "_point"), "_class").withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    cells = cells.select("tok", F.least("_block", "_other").alias("_i"), F.greatest("_block", "_other").alias("_j"), "_block", "_class", "root", "toks", "_point")
    more = cells.groupBy("tok", "_i", "_j").applyInArrow(_join_cell, "a long, b long")
    links2 = written(_verify(more, texts, width), "links")
    roots = components(links1.unionByName(links2))

    least = sets.where("n_shingles > 0").groupBy("_class").agg(
        F.min("doc_id").alias("_least"), F.count(F.lit(1)).alias("_copies"), F.min("n_shingles").alias("_size")
    )
    named = least.join(roots.withColumnRenamed("vertex", "_class"), "_class", "left").withColumn("root", F.coalesce("root", "_class"))
    named = written(named, "class-roots")
    by_root = named.groupBy("root").agg(
        F.min("_least").alias("component_id"), F.count(F.lit(1)).alias("_classes"), F.sum("_size").alias("_shingles"), F.sum("_copies").alias("_rows")
    )
    by_class = named.join(by_root, "root")
    if links:
        by_class = written(by_class, "class-components")
        by_class = by_class.join(_link_counts(by_class, texts, width), "_class", "left")
        others = F.when(F.col("_classes") > 2, F.coalesce("n", F.lit(0)) + F.col("_copies")).otherwise(F.col("_rows"))
        by_class = by_class.withColumn("n_links", others - 1)
    linked = ["n_links"] if links else []
    by_class = by_class.select("_class", "component_id", "root", *linked)
    salted = by_class.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(7))))
    out = sets.select("doc_id", "_row", "n_shingles", "_class", F.pmod("_row", F.lit(8)).cast("int").alias("_salt"))
    out = out.join(salted, ["_class", "_salt"], "left")
    wordless = F.col("n_shingles") == 0
    return out.select(
        "doc_id", "n_shingles", F.when(wordless, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(wordless, F.col("_row")).otherwise(F.col("root")).alias("_root"), "_row",
        *(F.when(wordless, F.lit(0)).otherwise(F.col(c)).cast("long").alias(c) for c in linked),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, without near duplicates: of each component the one
    with the least id (null ids last; then the least key). Of equal rows one stays, wordless rows too."""
    found = written(near_duplicates(docs, id_col, text), "near-duplicates")
    copies = found.groupBy("_root", "_row").agg(F.count(F.lit(1)).alias("_copies"), F.min("doc_id").alias("_id"))
    first = copies.groupBy("_root").agg(F.min(F.struct(F.col("_id").isNull().alias("u"), "_id", "_row", "_copies")).alias("x"))
    stay = written(first.select("x._row", "x._copies"), "near-duplicate-heads")
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    at = {c: F.col(n) for c, n in zip(docs.columns, names)}
    rows = plain.withColumn("_row", row_key(at[id_col], at[text])).join(stay.hint("shuffle_hash"), "_row")
    once = rows.where("_copies = 1").select(*names)
    again = rows.where("_copies > 1").dropDuplicates(["_row"]).select(*names)
    return once.unionByName(again).toDF(*docs.columns)


def op1_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    """Components of near duplicates over every whole text of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).drop("_row", "_root")


def op1_ngram_jaccard_links(spark, sf_dir: str) -> DataFrame:
    """op1_ngram_jaccard with n_links, each document's number of links."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs, links=True).drop("_row", "_root")
