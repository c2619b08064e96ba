"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

The vectors, as integers, are put in Hilbert order over their dimensions of
highest variance and cut into blocks of ``BLOCK`` rows.  A Parquet row holds one block and its
zone map: the least and greatest value of every dimension, and how often each label
occurs.  From it, interval arithmetic bounds the inner product of an anchor with
all rows of the block from both sides.

The anchors, a stated query set, are asked in batches of bounded size against
all blocks.  The zone columns alone tell which folders of blocks a batch must read,
first for the best rows of the anchors' own labels, then for the score windows
that those span; within a folder the bounds skip blocks and anchors again.
A task keeps only the best few rows per anchor and window.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prismtab.session import cut_lineage, ensure_checkpoint_dir

#: rows of a block (at most 1024: places share a number with the score), and of a folder of blocks
BLOCK, FOLDER = 1024, 1 << 16
#: folders at most, bytes of anchors that one batch hands to the tasks, rows of a batch at most
FOLDERS, BATCH_BYTES, BATCH_ROWS = 1024, 8 << 20, 1 << 14
#: dimensions and bits per dimension of the Hilbert order
DIMENSIONS, BITS = 6, 8
#: scores that no row reaches; the id of rows without one, which come last
NONE, NO_ID = np.int64(-(1 << 62)), np.int64((1 << 63) - 1)

STORED = T.StructType([
    T.StructField("folder", T.IntegerType()), T.StructField("rows", T.IntegerType()), T.StructField("anchors", T.IntegerType()),
    T.StructField("low", T.ArrayType(T.LongType())), T.StructField("high", T.ArrayType(T.LongType())),
    T.StructField("labels", T.ArrayType(T.LongType())), T.StructField("label_rows", T.ArrayType(T.LongType())),
    T.StructField("ids", T.BinaryType()), T.StructField("row_labels", T.BinaryType()), T.StructField("vectors", T.BinaryType()),
])
ZONES = ["folder", "low", "high", "labels", "label_rows"]
_ARROW = pa.schema([("folder", pa.int32()), ("rows", pa.int32()), ("anchors", pa.int32()), *[(c, pa.list_(pa.int64())) for c in ("low", "high", "labels", "label_rows")],
                    *[(c, pa.binary()) for c in ("ids", "row_labels", "vectors")]])


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells`` (below 2 ** bits; columns x bits up to 63)."""
    x = [c.astype(np.int64) for c in cells.T]
    for level in range(bits - 1, 0, -1):
        bit, rest = 1 << level, (1 << level) - 1
        for i in range(len(x)):
            up = (x[i] & bit) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & rest)
            x[0] = x[0] ^ np.where(up, rest, swap)
            x[i] = x[i] ^ swap if i else x[0]
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    place = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, -1, -1):
        for c in x:
            place = place << 1 | (c ^ turn) >> level & 1
    return place


def usable(rows: DataFrame, vector_id: str, vector: str, label) -> DataFrame:
    """id, label and integer vector of the rows that take part."""
    finite = f"forall(`{vector}`, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    rows = rows.where(F.col(vector).isNotNull() & F.expr(finite))
    rows = rows.select(F.col(vector_id).cast("long").alias("id"), label.cast("long").alias("label"), F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("long")).alias("v"))
    return rows.where("label is not null")


def write_blocks(rows: DataFrame, path: str, anchor: str) -> dict:
    """Write the blocks of ``rows`` (id, label, v) below ``path``; gives dims and folders, with the anchors of each."""
    spark = rows.sparkSession
    spread = rows.select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(F.min("x").alias("low"), F.max("x").alias("high"), F.var_pop("x").alias("spread"))
    spread = sorted(spread.collect(), key=lambda r: r.d)  # one row per dimension
    count = rows.count()
    dims = max([1, *(r.d + 1 for r in spread)])
    top = max([0, *(max(-r.low, r.high) for r in spread)])
    if dims * top * top >= 1 << 53:
        raise ValueError(f"components up to {top} in {dims} dimensions: scores beyond 53 bits")
    chosen = [(r.d, r.low, r.high) for r in sorted(spread, key=lambda r: (-r.spread, r.d))[:DIMENSIONS]] or [(0, 0, 0)]
    at, least = [d for d, _, _ in chosen], np.array([low for _, low, _ in chosen], float)
    step = np.array([max(1, high - low) for _, low, high in chosen], float)
    store = np.int16 if top < 1 << 15 else np.int64

    def matrix(column: pa.Array) -> np.ndarray:
        """All vectors as rows; missing components are zero."""
        sizes = np.diff(column.offsets.to_numpy())
        out = np.zeros((len(column), dims), np.int64)
        flat = column.flatten().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(column)), sizes)
        out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
        return out

    def place(frames):
        for batch in frames:
            cells = (matrix(batch.column(2))[:, at] - least) / step * ((1 << BITS) - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hilbert(cells.astype(np.int64), BITS))], ["id", "label", "v", "place"])

    def cut(frames):
        folder = TaskContext.get().partitionId()
        ids, labels, vectors = np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, dims), np.int64)

        def block(n):
            order = np.argsort(ids[:n], kind="stable")
            own, mark, v = ids[:n][order], labels[:n][order], vectors[:n][order]
            kinds, often = np.unique(mark, return_counts=True)
            values = [folder, n, int(((own % every == 0) & (own != NO_ID)).sum()), v.min(0).tolist(), v.max(0).tolist(), kinds.tolist(), often.tolist(),
                      own.tobytes(), mark.tobytes(), v.astype(store).tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(values, _ARROW)], schema=_ARROW)

        for batch in frames:
            got = batch.column(0)
            ids = np.concatenate([ids, got.fill_null(NO_ID.item()).to_numpy(zero_copy_only=False).astype(np.int64)])
            labels = np.concatenate([labels, batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)])
            vectors = np.concatenate([vectors, matrix(batch.column(2))])
            while len(ids) >= BLOCK:
                yield block(BLOCK)
                ids, labels, vectors = ids[BLOCK:], labels[BLOCK:], vectors[BLOCK:]
        if len(ids):
            yield block(len(ids))

    every = int(anchor)
    if not count:
        spark.createDataFrame([], STORED).write.parquet(path)
        return {"dims": dims, "store": store, "anchors": {}}
    folders = min(FOLDERS, max(spark.sparkContext.defaultParallelism, math.ceil(count / FOLDER)))
    keyed = rows.mapInArrow(place, T.StructType([*rows.schema.fields, T.StructField("place", T.LongType())]))
    # the id is in the order, so that a vector that very many rows share is spread over folders
    keyed = keyed.repartitionByRange(folders, "place", F.xxhash64("id")).sortWithinPartitions("place", F.xxhash64("id"), "id", "label")
    keyed.select("id", "label", "v").mapInArrow(cut, STORED).write.partitionBy("folder").parquet(path)
    held = spark.read.parquet(path).groupBy("folder").agg(F.sum("anchors").alias("n")).collect()
    return {"dims": dims, "store": store, "anchors": {r.folder: r.n for r in held}}


class Batch:
    """Some anchors with what is known of them; handed to every task that asks for them."""

    def __init__(self, ids, labels, vectors, store, most: int):
        self.ids, self.labels, self.vectors, self.store, self.most = ids, labels, vectors.astype(float), store, most
        self.up, self.down = np.maximum(self.vectors, 0), np.minimum(self.vectors, 0)
        self.floor = np.full(len(ids), NONE)  # some row of the own label is sure to score so much

    def bounds(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible score of every anchor with rows between ``low`` and ``high`` (a row per block)."""
        low, high = low.astype(float), high.astype(float)
        return (self.up @ low.T + self.down @ high.T).astype(np.int64), (self.up @ high.T + self.down @ low.T).astype(np.int64)

    def sure(self, low, high, counts) -> np.ndarray:
        """Per anchor, a score that ``most`` other rows of its label reach for sure; counts: rows of its label per block."""
        least, _ = self.bounds(low, high)
        order = np.argsort(-least, axis=1, kind="stable")
        upto = np.cumsum(np.take_along_axis(counts, order, 1), 1) > self.most  # one may be the anchor
        first = upto.argmax(1)
        found = np.take_along_axis(np.take_along_axis(least, order, 1), first[:, None], 1)[:, 0]
        return np.where(upto.any(1), found, NONE)

    def label_rows(self, zones) -> np.ndarray:
        """Rows of each anchor's label in each block."""
        out = np.zeros((len(self.ids), len(zones)), np.int64)
        for b, (kinds, often) in enumerate(zones):
            at = np.minimum(np.searchsorted(kinds, self.labels), len(kinds) - 1)
            out[:, b] = np.where(kinds[at] == self.labels, often[at], 0)
        return out


def top(packed: np.ndarray, k: int) -> np.ndarray:
    """The k greatest of each row, descending; ``NONE`` where there are fewer."""
    if packed.shape[1] > k:
        packed = np.partition(packed, packed.shape[1] - k, axis=1)[:, -k:]
    elif packed.shape[1] < k:
        packed = np.pad(packed, ((0, 0), (0, k - packed.shape[1])), constant_values=NONE)
    return -np.sort(-packed, axis=1)


class Best:
    """The k best (score, id) for each of some questions."""

    def __init__(self, questions: int, k: int):
        self.scores, self.ids = np.full((questions, k), NONE), np.full((questions, k), NO_ID)

    def add(self, rows: np.ndarray, packed: np.ndarray, ids: np.ndarray) -> None:
        """``packed``: score and place of rows of one block, sorted by id, for the questions ``rows``."""
        k = self.scores.shape[1]
        best = top(packed, k)
        live = best[:, 0] != NONE
        rows, best = rows[live], best[live]
        own = best != NONE
        scores = np.concatenate([self.scores[rows], np.where(own, best >> 10, NONE)], 1)
        who = np.concatenate([self.ids[rows], np.where(own, ids[np.where(own, 1023 - (best & 1023), 0)], NO_ID)], 1)
        order = np.lexsort((who, -scores), axis=1)[:, :k]
        self.scores[rows], self.ids[rows] = np.take_along_axis(scores, order, 1), np.take_along_axis(who, order, 1)

    def rows(self) -> pa.RecordBatch:
        question, at = np.nonzero(self.scores != NONE)
        who = self.ids[question, at]
        return pa.RecordBatch.from_arrays([pa.array(question), pa.array(self.scores[question, at]), pa.array(who, mask=who == NO_ID)], ["question", "score", "id"])


FOUND = "question long, score long, id long"


def zone_arrays(batch: pa.RecordBatch, dims: int):
    """Folders, low, high and label counts of the blocks of an Arrow batch of zone columns."""
    low, high = (batch.column(c).flatten().to_numpy().reshape(-1, dims) for c in (1, 2))
    kinds = [(np.array(k), np.array(n)) for k, n in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
    return batch.column(0).to_numpy(), low, high, kinds


def ask(blocks: DataFrame, batch, dims: int, k: int, width: int, wanted, mask) -> DataFrame:
    """Best ``k`` rows for each question (``width`` per anchor) over the blocks: question, score, id, summed over tasks.

    wanted(batch, least, most, label rows, best) tells which questions a block may still change,
    mask(batch, questions, scores, labels) which of its rows answer them."""

    def run(frames):
        own, best = batch.value, None
        for frame in frames:
            folder, low, high, kinds = zone_arrays(frame, dims)
            least, most = own.bounds(low, high)
            counts = own.label_rows(kinds)
            best = best or Best(len(own.ids) * width, k)
            for b in range(frame.num_rows):
                ids = np.frombuffer(frame.column(5)[b].as_buffer(), np.int64)
                questions = np.flatnonzero(wanted(own, least[:, b], most[:, b], counts[:, b], len(ids), best))
                if not len(questions):
                    continue
                labels = np.frombuffer(frame.column(6)[b].as_buffer(), np.int64)
                vectors = np.frombuffer(frame.column(7)[b].as_buffer(), own.store).reshape(len(ids), dims).astype(float)
                asked, of = np.unique(questions // width, return_inverse=True)
                scores = (own.vectors[asked] @ vectors.T).astype(np.int64)
                packed = (scores << 10) + (1023 - np.arange(len(ids)))
                for slot in range(width):
                    some = questions % width == slot
                    at = of[some]
                    if len(at):
                        best.add(questions[some], np.where(mask(own, questions[some], scores[at], labels, ids), packed[at], NONE), ids)
        if best is not None:
            yield best.rows()

    found = blocks.select(*ZONES, "ids", "row_labels", "vectors").coalesce(max(1, blocks.sparkSession.sparkContext.defaultParallelism)).mapInArrow(run, FOUND)
    order = Window.partitionBy("question").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def needed(blocks: DataFrame, batch, dims: int, wanted) -> list[int]:
    """Folders with a block that some question of the batch must read, from the zone columns alone."""

    def run(frames):
        own = batch.value
        for frame in frames:
            folder, low, high, kinds = zone_arrays(frame, dims)
            least, most = own.bounds(low, high)
            counts, rows = own.label_rows(kinds), np.array([n.sum() for _, n in kinds])
            live = [f for b, f in enumerate(folder) if wanted(own, least[:, b], most[:, b], counts[:, b], rows[b], None).any()]
            yield pa.RecordBatch.from_arrays([pa.array(live, pa.int32())], ["folder"])

    return sorted(r.folder for r in blocks.select(*ZONES).mapInArrow(run, "folder int").distinct().collect())


def for_positives(own: Batch, least, most, own_rows, rows, best):
    """Anchors for which a block may hold one of the best rows of their label."""
    limit = own.floor if best is None else np.maximum(own.floor, best.scores[:, -1])
    return (own_rows > 0) & (most >= limit)


def positive_rows(own: Batch, questions, scores, labels, ids):
    return (labels[None, :] == own.labels[questions][:, None]) & (ids[None, :] != own.ids[questions][:, None])


def for_windows(own: Batch, least, most, own_rows, rows, best):
    """(anchor, positive) questions whose window of scores a block may meet."""
    live = (own_rows < rows)[:, None] & (own.first <= own.last) & (most[:, None] >= own.first) & (least[:, None] <= own.last)
    if best is not None:
        live &= np.minimum(most[:, None], own.last) >= best.scores[:, -1].reshape(live.shape)
    return live.ravel()


def window_rows(own: Batch, questions, scores, labels, ids):
    anchor, slot = np.divmod(questions, own.first.shape[1])
    low, high = own.first[anchor, slot][:, None], own.last[anchor, slot][:, None]
    return (labels[None, :] != own.labels[anchor][:, None]) & (scores >= low) & (scores <= high)


def batches_of(anchors: dict[int, int], limit: int) -> list[tuple[list[int], int, int]]:
    """(folders, parts, part): neighbouring folders together up to ``limit`` anchors; a folder of more in parts."""
    out, run, size = [], [], 0
    for folder, n in sorted(anchors.items()):
        if n and run and size + n > limit:
            out.append((run, 1, 0))
            run, size = [], 0
        if n > limit:
            parts = math.ceil(n / limit)
            out += [([folder], parts, p) for p in range(parts)]
        elif n:
            run, size = [*run, folder], size + n
    return out + ([(run, 1, 0)] if run else [])


def mine(rows: DataFrame, vector_id: str = "vec_id", vector: str = "embedding", label=None, every: int = 50, positives: int = 5, negatives: int = 3) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id ``every`` divides; their positives the
    ``positives`` best rows of another id and the same label; the negatives of both the first
    ``negatives`` rows of another label that score from 50 to 95 percent of the positive.
    Higher scores come first, then smaller ids; a null id is no anchor and comes last.
    Rows with a null label, a null vector, or a null or non-finite component take no part;
    missing trailing components are zero, an empty vector scores 0.  Repeated rows are rows of their own (of an anchor, too).
    ``label`` is a Column, the column label by default.  Components as integers must keep scores within 53 bits, else this raises.
    An empty input gives an empty result; other columns are not read."""
    spark = rows.sparkSession
    label = F.col("label") if label is None else label
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/negatives-{spark.sparkContext._jvm.java.util.UUID.randomUUID()}"
    held = write_blocks(usable(rows, vector_id, vector, label), path, every)
    dims, stored = held["dims"], held["store"]
    blocks = spark.read.schema(STORED).parquet(path)
    limit = max(1, min(BATCH_ROWS, BATCH_BYTES // max(8, 8 * dims)))
    out = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")

    def anchors(frames):
        for frame in frames:
            for ids, labels, vectors in zip(*(frame.column(c) for c in range(3))):
                own = np.frombuffer(ids.as_buffer(), np.int64)
                at = np.flatnonzero((own % every == 0) & (own != NO_ID))
                v = np.frombuffer(vectors.as_buffer(), stored).reshape(len(own), dims)
                yield pa.RecordBatch.from_arrays([pa.array(own[at]), pa.array(np.frombuffer(labels.as_buffer(), np.int64)[at]), pa.array([x.tobytes() for x in v[at]], pa.binary())], ["id", "label", "v"])

    def guess(batch):
        def run(frames):
            own, best = batch.value, None
            for frame in frames:
                _, low, high, kinds = zone_arrays(frame, dims)
                sure = own.sure(low, high, own.label_rows(kinds))
                best = sure if best is None else np.maximum(best, sure)
            if best is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(best))), pa.array(best)], ["anchor", "sure"])

        return run

    for folders, parts, part in batches_of(held["anchors"], limit):
        asked = blocks.where(F.col("folder").isin(folders)).select("ids", "row_labels", "vectors").mapInArrow(anchors, "id long, label long, v binary")
        asked = asked.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == part).collect()  # bounded by the batch
        asked.sort(key=lambda r: (r.id, r.label, r.v))
        vectors = np.frombuffer(b"".join(r.v for r in asked), stored).reshape(len(asked), dims)
        own = Batch(np.array([r.id for r in asked], np.int64), np.array([r.label for r in asked], np.int64), vectors, stored, positives)

        first = spark.sparkContext.broadcast(own)
        for r in blocks.select(*ZONES).mapInArrow(guess(first), "anchor long, sure long").groupBy("anchor").agg(F.max("sure").alias("sure")).collect():
            own.floor[r.anchor] = r.sure
        second = spark.sparkContext.broadcast(own)
        near = blocks.where(F.col("folder").isin(needed(blocks, second, dims, for_positives)))
        best = np.full((len(asked), positives), NONE)
        who: list[list] = [[None] * positives for _ in asked]
        for r in ask(near, second, dims, positives, 1, for_positives, positive_rows).collect():
            best[r.question, r["rank"] - 1], who[r.question][r["rank"] - 1] = r.score, r.id

        # 50 p <= 100 n <= 95 p
        own.first, own.last = -(-best // 2), np.where(best == NONE, NONE * 2, best * 19 // 20)
        third = spark.sparkContext.broadcast(own)
        near = blocks.where(F.col("folder").isin(needed(blocks, third, dims, for_windows)))
        found = ask(near, third, dims, negatives, positives, for_windows, window_rows)
        pairs = [(a * positives + s, asked[a].id, who[a][s], int(best[a, s])) for a in range(len(asked)) for s in range(positives) if best[a, s] != NONE]
        pairs = spark.createDataFrame(pairs, "question long, anchor_id long, positive_id long, positive_score long")
        found = found.join(pairs, "question").select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        out = out.unionByName(cut_lineage(found))
    return out
