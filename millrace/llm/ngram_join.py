"""N-gram Jaccard self-join with adaptive multi-match prefixes.

Shingles are ordered by an estimated frequency and then by hash. Two sets that reach the threshold
share at least L shingles within prefixes of length ``n - ceil(t*n) + L``, for any L. Each document
takes the L that makes its estimated lists and verifications cheapest, so a pair must share the
smaller of its two L before it is verified.

A document stays in the search only if, for some number of matches up to its own L, that many of
its prefix shingles stand in other prefixes whose owners ask for no more; few that share a shingle by
chance do. The rest that share a prefix shingle form loose components. In blocks of them, which hold prefixes
only, matches are counted and those that suffice form tight components; in blocks of these, which
hold texts, candidates are verified. Blocks are of bounded size, and no pair is ever a row: a block
returns a forest of its groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.shared import (
    Broadcasted,
    array_pieces,
    components,
    fields,
    forget,
    in_filter,
    key_filter,
    map_groups,
    meetings,
    release,
    small_batches,
    staged,
    sum_arrays,
    text_key,
)
from millrace.llm.words import mix, rolling, slices, split_words

WIDTH = 4
PERCENT = 85
# Cells of the frequency sketch: its size is fixed, and only the order of shingles rests on it.
SKETCH_CELLS = 1 << 22
MOST_SHARED = 16
VERIFY_COST = 30.0
# Rounds in which documents without enough shared prefix shingles leave the search; each is one
# aggregation over what the round before left, and any number of them is right.
LEAVING_ROUNDS = 2
# A list estimated to be longer is dealt to several tasks.
LIST_ROWS = 20_000
# A block holds at most about so many documents and shingles.
BLOCK_DOCS = 4000
BLOCK_SHINGLES = 4_000_000
PREFIX_BLOCK_DOCS = 40_000
PREFIX_BLOCK_SHINGLES = 24_000_000


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    A text of fewer than ``width`` words has its whole sequence as one shingle; one without words
    has none.
    """
    words = split_words(texts, lower=True)
    hashes = words.hashes() if len(words.start) else np.zeros(0, np.uint64)
    runs = rolling(hashes, width)
    out = []
    for first, last in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if last - first >= width:
            values = np.sort(runs[first : last - width + 1])
            fresh = np.empty(len(values), bool)
            fresh[0] = True
            np.not_equal(values[1:], values[:-1], out=fresh[1:])
            out.append(values[fresh])
        elif last > first:
            whole = rolling(hashes[first:last], last - first)
            out.append(mix(whole + np.uint64(last - first)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


class PrefixRule:
    """Chooses a set's prefix and the number of prefix shingles a partner must share."""

    def __init__(self, sketch: np.ndarray, percent: int):
        self.sketch = sketch
        self.percent = percent
        load = float(sketch.mean())
        # What a cell holds by chance says nothing about one shingle.
        self.noise = load + 3 * math.sqrt(load) + 1

    def estimate(self, shingles: np.ndarray) -> np.ndarray:
        return self.sketch[(shingles % np.uint64(len(self.sketch))).astype(np.int64)]

    def prefix(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Prefix shingles, their estimated lists, and the matches a partner needs."""
        n = len(shingles)
        estimate = self.estimate(shingles)
        order = np.lexsort((shingles, estimate))
        needed = -(-self.percent * n // 100)
        most = max(1, min(MOST_SHARED, needed))
        # The list of a prefix shingle holds one document at least, so a longer prefix has a price.
        lists = np.maximum(estimate[order[: n - needed + most]] - self.noise, 1.0)
        sums = np.cumsum(lists)[n - needed :]
        shared = np.arange(1, len(sums) + 1)
        chosen = int(np.argmin(sums * (1.0 + VERIFY_COST / shared))) + 1
        at = order[: n - needed + chosen]
        return shingles[at], np.maximum(estimate[at] - self.noise, 0.0), chosen


def _measure(docs: DataFrame, carry: list[str], width: int) -> DataFrame:
    """Rows of documents with their set size and, with ``piece`` set, a sketch of each task."""
    own = fields("_tid long, n_shingles long, piece int, data binary")
    columns = [docs.schema[c] for c in carry]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in columns] + own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(SKETCH_CELLS, np.int64)
        names, kinds = [], []
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            sizes = []
            for a, b in slices(texts):
                sets = shingle_sets(texts.slice(a, b - a), width)
                sizes += [len(s) for s in sets]
                cells = np.concatenate(sets) % np.uint64(SKETCH_CELLS)
                np.add.at(sketch, cells.astype(np.int64), 1)
            kept = [batch.column(batch.schema.get_field_index(c)) for c in [*carry, "_tid"]]
            names, kinds = [*carry, "_tid"], [c.type for c in kept]
            none = [pa.nulls(len(texts), pa.int32()), pa.nulls(len(texts), pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sizes, pa.int64()), *none],
                names=[*names, "n_shingles", "piece", "data"],
            )
        if names:
            made = array_pieces(sketch)
            count = len(made["piece"])
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(count, k) for k in kinds]
                + [
                    pa.nulls(count, pa.int64()),
                    pa.array(made["piece"], pa.int32()),
                    pa.array(made["data"], pa.binary()),
                ],
                names=[*names, "n_shingles", "piece", "data"],
            )
        release()

    return docs.mapInArrow(run, schema)


def _prefix_rows(texts: DataFrame, rule: Broadcasted, width: int) -> DataFrame:
    """``token, part, tid, need``; ``part`` deals a long list to several tasks and is -1 otherwise."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            tids = batch.column(0).to_numpy()
            for a, b in slices(column):
                tokens, parts, owners, needs = [], [], [], []
                for tid, shingles in zip(
                    tids[a:b], shingle_sets(column.slice(a, b - a), width), strict=True
                ):
                    if not len(shingles):
                        continue
                    prefix, lists, need = rule.value.prefix(shingles)
                    pieces = (lists // LIST_ROWS).astype(np.uint64) + np.uint64(1)
                    salt = mix(prefix ^ np.uint64(int(tid) % 2**64)) % pieces
                    parts.append(np.where(pieces == 1, -1, salt.astype(np.int64)))
                    tokens.append(prefix)
                    owners.append(np.full(len(prefix), tid, np.int64))
                    needs.append(np.full(len(prefix), need, np.int8))
                if tokens:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(tokens).view(np.int64)),
                            pa.array(np.concatenate(parts).astype(np.int32)),
                            pa.array(np.concatenate(owners)),
                            pa.array(np.concatenate(needs)),
                        ],
                        names=["token", "part", "tid", "need"],
                    )
        release()

    return texts.select("_tid", "text").mapInArrow(
        run, "token long, part int, tid long, need tinyint"
    )


def _shared_rows(rows: DataFrame) -> DataFrame:
    """Distinct rows whose list has a further document, with ``least``, the list's smallest need.

    Of a list dealt to several tasks no task sees all: its rows stay, as if it wanted one match.
    """
    key = ["token", "part"]
    names = [*key, "tid", "need", "least"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A list's first row has its least need, and waits for a second document of the list.
        # ``before`` is the last row met, its list's least need, and whether it still waits.
        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            met = np.stack([c.to_numpy().astype(np.int64) for c in batch.columns], 1)
            if before is not None:
                met = np.concatenate([before[None, :4], met])
            met = met[np.append(True, (met[1:, :3] != met[:-1, :3]).any(1))]
            starts = np.append(True, (met[1:, :2] != met[:-1, :2]).any(1))
            least = met[starts, 3]
            split = met[:, 1] >= 0
            shared = split | ~starts | np.append(~starts[1:], False)
            waits = bool(starts[-1] and not split[-1])
            if before is not None:
                least[0] = before[4]
                shared[0] &= bool(before[5])
                if len(met) == 1:
                    waits = bool(before[5])
            found = np.column_stack([met, np.where(split, 1, least[np.cumsum(starts) - 1])])[shared]
            before = np.array([*met[-1], least[-1], waits])
            if len(found):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[:, i], pa.int64()).cast(k) for i, k in enumerate(kinds)],
                    names=names,
                )
        release()

    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int8(), pa.int8()]
    dealt = rows.select(*names[:4]).repartition(*key).sortWithinPartitions(*key, "need", "tid")
    return dealt.mapInArrow(run, "token long, part int, tid long, need tinyint, least tinyint")


def _with_partners(rows: DataFrame) -> DataFrame:
    """``rows`` of the documents that may share as many prefix shingles as some pair of theirs asks.

    A pair that asks for k matches shares k lists in which k or less is the smallest need, and k is
    at most the document's own need.
    """
    within = [F.count_if(F.col("least") <= k).alias(f"c{k}") for k in range(1, MOST_SHARED + 1)]
    sums = rows.groupBy("tid").agg(F.max("need").alias("own"), *within)
    enough = F.lit(False)
    for k in range(1, MOST_SHARED + 1):
        enough = enough | ((F.col("own") >= k) & (F.col(f"c{k}") >= k))
    return rows.join(sums.filter(enough).select("tid"), "tid", "left_semi")


def _prefix_sets(texts: DataFrame, rule: Broadcasted, wanted: Broadcasted, width: int) -> DataFrame:
    """``_tid, n, need, prefix`` of the documents that may be in ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(in_filter(wanted.value, batch.column(0).to_numpy())))
            column = batch.column(1)
            for a, b in slices(column):
                sets = shingle_sets(column.slice(a, b - a), width)
                full = [i for i, s in enumerate(sets) if len(s)]
                chosen = [rule.value.prefix(sets[i]) for i in full]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a).take(pa.array(full, pa.int64())),
                        pa.array([len(sets[i]) for i in full], pa.int64()),
                        pa.array([c[2] for c in chosen], pa.int32()),
                        pa.array([c[0].tobytes() for c in chosen], pa.binary()),
                    ],
                    names=["_tid", "size", "need", "prefix"],
                )
        release()

    made = texts.select("_tid", "text").mapInArrow(
        run, "_tid long, size long, need int, prefix binary"
    )
    return made.withColumnRenamed("size", "n")


def _list_edges(rows: DataFrame) -> DataFrame:
    """Edges from each member of a list to the first; a part's first member goes up as ``up``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        pivot = 0
        for batch in batches:
            token, part, tid = (batch.column(i).to_numpy() for i in range(3))
            if not len(token):
                continue
            starts = np.empty(len(token), bool)
            starts[0] = last != (token[0], part[0])
            starts[1:] = (token[1:] != token[:-1]) | (part[1:] != part[:-1])
            group = np.cumsum(starts)
            firsts = np.concatenate([[pivot], tid[starts]])
            pivots = firsts[group]
            last, pivot = (token[-1], part[-1]), int(pivots[-1])
            differ = tid != pivots
            edges = np.unique(np.stack([tid[differ], pivots[differ]], 1), axis=0)
            up = starts & (part >= 0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([edges[:, 0], tid[up]])),
                    pa.concat_arrays([pa.array(edges[:, 1]), pa.nulls(int(up.sum()), pa.int64())]),
                    pa.concat_arrays([pa.nulls(len(edges), pa.int64()), pa.array(token[up])]),
                ],
                names=["a", "b", "up"],
            )

    dealt = rows.select("token", "part", "tid").repartition("token", "part")
    ordered = dealt.sortWithinPartitions("token", "part", "tid")
    return ordered.mapInArrow(run, "a long, b long, up long")


def _candidate_components(rows: DataFrame) -> DataFrame:
    shared = []
    for _ in range(LEAVING_ROUNDS):
        shared.append(staged(_shared_rows(rows), "shared"))
        rows = _with_partners(shared[-1])
    edges = staged(_list_edges(rows), "lists")
    forget(*shared)
    tops = edges.filter("up is not null").select("up", "a")
    first = tops.groupBy("up").agg(F.min("a").alias("b"))
    joined = tops.join(first, "up").select("a", "b")
    found = components(edges.filter("up is null").select("a", "b").union(joined))
    forget(edges)
    return found


def _counts(members: list[np.ndarray], chunk: int = 1024) -> np.ndarray:
    """How many values every two of the sorted arrays share."""
    m = len(members)
    owner = np.repeat(np.arange(m), [len(x) for x in members])
    _, place, many = np.unique(np.concatenate(members), return_inverse=True, return_counts=True)
    common = np.cumsum(many > 1) - 1
    held = many[place] > 1
    owner, place = owner[held], common[place[held]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    out = np.zeros((m, m), np.float32)
    for base in range(0, int(place[-1]) + 1 if len(place) else 0, chunk):
        a, b = np.searchsorted(place, [base, base + chunk])
        grid = np.zeros((m, chunk), np.float32)
        grid[owner[a:b], place[a:b] - base] = 1
        out += grid @ grid.T
    return out


def _labels(edges_of, count: int) -> np.ndarray:
    """The least member of each node's group; ``edges_of(i)`` gives partners of node i above it."""
    label = np.arange(count)
    for i in range(count):
        met = np.unique(label[edges_of(i, label)])
        met = met[met != label[i]]
        if len(met):
            met = np.append(met, label[i])
            label[np.isin(label, met)] = met.min()
    return label


def _candidates(tids: np.ndarray, block: pa.Table, percent: int) -> np.ndarray:
    """Groups of documents that share as many prefix shingles as the smaller need of the two."""
    prefixes = [np.frombuffer(p, np.uint64) for p in block.column("prefix").to_pylist()]
    needs = block.column("need").to_numpy()
    sizes = block.column("n").to_numpy()
    owner = np.repeat(np.arange(len(tids)), [len(p) for p in prefixes])
    tokens = np.concatenate(prefixes)
    order = np.argsort(tokens, kind="stable")
    owner, tokens = owner[order], tokens[order]
    bounds = np.append(np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1])), len(tokens))
    many = np.diff(bounds)
    ends = np.repeat(bounds[1:], many)
    # Where each document stands in the lists it shares with a later one.
    shared = np.flatnonzero(np.arange(1, len(tokens) + 1) < ends)
    by_doc = shared[np.argsort(owner[shared], kind="stable")]
    first = np.searchsorted(owner[by_doc], np.arange(len(tids) + 1))

    def partners(i: int, label: np.ndarray) -> np.ndarray:
        at = by_doc[first[i] : first[i + 1]]
        if not len(at):
            return at
        later = np.concatenate([owner[x + 1 : e] for x, e in zip(at, ends[at], strict=True)])
        other, matches = np.unique(later, return_counts=True)
        fits = 100 * np.minimum(sizes[i], sizes[other]) >= percent * np.maximum(
            sizes[i], sizes[other]
        )
        return other[fits & (matches >= np.minimum(needs[i], needs[other]))]

    return _labels(partners, len(tids))


def _links(sets: list[np.ndarray], rule: PrefixRule) -> np.ndarray:
    """Groups of verified links among documents whose prefixes match often enough."""
    sizes = np.array([len(s) for s in sets])
    chosen = [rule.prefix(s) for s in sets]
    needs = np.array([c[2] for c in chosen])
    shared = _counts([c[0] for c in chosen])
    whole = _counts(sets) if len(sets) > 8 else None

    def partners(i: int, label: np.ndarray) -> np.ndarray:
        enough = shared[i] >= np.minimum(needs[i], needs)
        high = np.maximum(sizes[i], sizes)
        enough &= 100 * np.minimum(sizes[i], sizes) >= rule.percent * high
        other = np.flatnonzero(enough & (label != label[i]))
        other = other[other > i]
        if whole is None:
            both = np.array(
                [len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for j in other], int
            )
        else:
            both = whole[i, other].astype(np.int64)
        return other[100 * both >= rule.percent * (sizes[i] + sizes[other] - both)]

    return _labels(partners, len(sets))


def _edges(tids: np.ndarray, label: np.ndarray) -> dict | None:
    """A group's members and its least id; a block without groups gives nothing."""
    moved = np.flatnonzero(label != np.arange(len(label)))
    return {"a": tids[moved], "b": tids[label[moved]]} if len(moved) else None


def jaccard_components(
    docs: DataFrame,
    carry: list[str],
    width: int = WIDTH,
    percent: int = PERCENT,
    id_column: str = "doc_id",
) -> DataFrame:
    """``carry`` columns of every document, ``n_shingles``, ``component_id`` and ``kept``.

    Two documents link when their shingle sets reach ``percent`` Jaccard; a component's id is the
    least document id in it, and ``kept`` marks one row of it (least id, then first read). Texts
    that are null, empty or blank have no shingles, link with nothing and keep their own id. Equal
    texts are one node, named by 64 bits of hash; repeated rows are rows of their own. A null id is
    carried, counts only if a component has no other, and then its component id is null.
    """
    spark = docs.sparkSession
    small_batches(spark)
    carry = list(dict.fromkeys([id_column, *carry]))
    # Carried columns travel under names of their own.
    inner = docs.select(
        *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carry)],
        F.col("text").cast("string").alias("text"),
        text_key().alias("_tid"),
    )
    held = [f"_c{i}" for i in range(len(carry))]
    measured = staged(
        _measure(inner, held, width).withColumn("_row", F.monotonically_increasing_id()), "sets"
    )
    rows = measured.filter("piece is null").drop("piece", "data")
    pieces = b"".join(sum_arrays(measured.filter("piece is not null")))
    sketch = np.frombuffer(pieces, np.int64) if pieces else np.zeros(SKETCH_CELLS, np.int64)
    rule = Broadcasted(spark, PrefixRule(sketch.astype(np.int32), percent))

    texts = inner.select("_tid", "text")
    loose = staged(_candidate_components(_prefix_rows(texts, rule, width)), "loose")
    sizes = rows.groupBy("_tid").agg(F.first("n_shingles").alias("n"))

    def met(found: DataFrame, most_docs: int, most_weight: int) -> DataFrame:
        # Partners' sizes differ by the threshold at most, so by one such class.
        step = -math.log(percent / 100 - 0.001)
        nodes = found.select(F.col("node").alias("_tid"), "component").join(sizes, "_tid")
        classed = nodes.withColumn("class", F.floor(F.log("n") / step).cast("int"))
        return meetings(
            staged(classed, "nodes"), "_tid", "component", "n", most_docs, most_weight
        ).select("_tid", F.explode("meetings.key").alias("key"))

    prefixes = _prefix_sets(texts, rule, Broadcasted(spark, key_filter(loose, "node")), width)
    prefixes = prefixes.dropDuplicates(["_tid"]).join(
        met(loose, PREFIX_BLOCK_DOCS, PREFIX_BLOCK_SHINGLES), "_tid"
    )

    def match(block: pa.Table) -> dict | None:
        tids, first = np.unique(block.column("_tid").to_numpy(), return_index=True)
        return _edges(tids, _candidates(tids, block.take(pa.array(first)), percent))

    tight = staged(components(map_groups(prefixes, "key", match, "a long, b long")), "tight")
    wanted = Broadcasted(spark, key_filter(tight, "node"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_filter(wanted.value, batch.column(0).to_numpy())))

    chosen = texts.mapInArrow(pick, texts.schema).groupBy("_tid").agg(F.first("text").alias("text"))
    blocks = chosen.join(met(tight, BLOCK_DOCS, BLOCK_SHINGLES), "_tid")

    def link(block: pa.Table) -> dict | None:
        tids, first = np.unique(block.column("_tid").to_numpy(), return_index=True)
        if len(tids) < 2:
            return None
        text = block.column("text").take(pa.array(first)).combine_chunks()
        text = text if isinstance(text, pa.Array) else pa.concat_arrays(text.chunks)
        return _edges(tids, _links(shingle_sets(text, width), rule.value))

    linked = staged(components(map_groups(blocks, "key", link, "a long, b long")), "linked")

    first = F.min(F.struct(F.col("_c0").isNull().alias("none"), F.col("_c0").alias("id"), F.col("_row").alias("row")))
    classes = rows.filter("n_shingles > 0").groupBy("_tid").agg(first.alias("first"))
    rooted = classes.join(linked.toDF("_tid", "root"), "_tid", "left").withColumn(
        "root", F.coalesce("root", "_tid")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    by_class = rooted.join(least, "root").select("_tid", "least")
    joined = rows.join(by_class, "_tid", "left")
    alone = F.col("n_shingles") == 0
    own = ("n_shingles", "component_id", "kept")
    return joined.select(
        *[F.col(h).alias(c) for h, c in zip(held, carry, strict=True) if c not in own],
        "n_shingles",
        F.when(alone, F.col("_c0")).otherwise(F.col("least.id")).alias("component_id"),
        (alone | (F.col("_row") == F.col("least.row"))).alias("kept"),
    )
