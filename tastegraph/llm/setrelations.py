"""Groups of documents linked by the Jaccard similarity of their shingles: an exact join that skips by set relations.

The shingles of all sets are ordered from the rarest to the most frequent. Two sets that share enough must share a
shingle among the first few of both (their prefixes), and there the place of the first common shingle bounds how many
can be common. The steps:

1. **Frequencies.** Each task hashes its texts and sends shingles, six bytes each, to buckets by hash; a bucket counts
   them and sends back only those that several sets have. A set with a prefix of shingles of its own has no links and is
   finished; most sets are.
2. **Index lists.** A prefix shingle's list holds ``(set, size, position)``. It is cut into blocks of equal size and
   position. Blocks that no other block of the list can match leave the index; later a probing set skips every block whose
   size and position leave no room, without looking at its members.
3. **Answers from similar sets.** The member with the fewest rarer shingles is a list's first leader and probes it. Its
   answers are computed on whole sets and kept with the few shingles in which each member differs from it. They serve
   two members ``y``, ``z`` of one leader ``x`` in the order of cost: members of one component need no answer;
   ``|yx| + |zx| - |x|`` common shingles are certain, and more than ``|yx| + |z| - |zx|`` impossible; and what is still open
   follows from the differences alone: ``|x| - |(x-y) or (x-z)| + |(y-x) and (z-x)|``. Only sets without a common leader are
   compared as a whole. Rounds have 1, 8, 64 ... leaders a list, until all members of a list are connected or have led.

Equal sets are one set from the start, so copies cost one row each. No list is collected: blocks have pages, a busy leader's
pairs have pages, and a shingle that a third of all sets have comes back to its documents from a side table of the task.
A set is known by 64 bits of its fingerprint, a shingle by 64 bits (in lists by at least 32: that only adds candidates).

Edge cases: a null or empty text, or one of blanks, has an empty set and links to nothing; a text shorter than a
shingle is one shingle; rows with one id are one document; rows without an id link to nothing; an empty table gives an
empty result; very long texts are ordinary; columns of other names play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastegraph.llm.components import components
from tastegraph.llm.neardup import prints
from tastegraph.llm.wordhash import in_chunks, shingle_sets
from tastegraph.plans.durable import durable
from tastegraph.plans.lookup import lookup

WORDS, PERCENT = 3, 90
# So many ids, a few numbers each, are broadcast.
BROADCAST_IDS = 300_000
# A task counts shingles of so many sets, or shingles, at once; a bucket has about so many. A shingle needs some 50 bytes there.
# Rows between tasks hold chunk x bucket / total shingles, so raise both with the executors' memory beyond a terabyte of text.
CHUNK_SETS, CHUNK_SHINGLES, BUCKET_SHINGLES = 50_000, 600_000, 800_000
# A shingle of more sets of a chunk goes to its bucket once, its sets stay in the side table.
LOCAL = 8
MANY = 0xFFFF
# Leaders of a list in a round, as a multiple of those in the round before; rows of a page.
GROWTH, PAGE = 8, 512

SIZED = "doc_id long, n long, f1 long, f2 long"
SENT = "bucket long, chunk long, shingles binary, owners binary, counts binary"
RARITY = "chunk long, bucket long, shingles binary, owners binary, ranks binary"
ENTRIES = "key long, sid long, n long, pos long"


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n - -(-percent * n // 100) + 1


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """Ids and sets of rows ``(id, text)``, few at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part, at = batch.slice(start, 256), 0
            for chunk in in_chunks(part.column(1).cast(pa.binary()).to_pylist()):
                yield part.column(0).slice(at, len(chunk)), list(shingle_sets(chunk, words))
                at += len(chunk)


def sized(docs: DataFrame, words: int) -> DataFrame:
    """``(doc_id, n, f1, f2)``: sizes and fingerprints of the sets of rows ``(doc_id, text)``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _sets(batches, words):
            marks = prints(sets)
            columns = [pa.array([len(s) for s in sets], pa.int64()), pa.array(marks[:, 0]), pa.array(marks[:, 1])]
            yield pa.RecordBatch.from_arrays([ids, *columns], names=["doc_id", "n", "f1", "f2"])

    return docs.mapInArrow(rows, SIZED)


def whole_sets(docs: DataFrame, words: int) -> DataFrame:
    """``(sid, hashes)`` of rows ``(doc_id, text)``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _sets(batches, words):
            hashes = pa.array([s.tobytes() for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(prints(sets)[:, 0]), hashes], names=["sid", "hashes"])

    return docs.mapInArrow(rows, "sid long, hashes binary").dropDuplicates(["sid"])


class _Chunk:
    """Sets of a task that are counted together."""

    def __init__(self, number: int, buckets: int):
        self.number, self.buckets = number, buckets
        self.sets: list[np.ndarray] = []
        self.sids: list[int] = []
        self.size = 0

    def add(self, one: np.ndarray, sid: int) -> None:
        self.sets.append(one)
        self.sids.append(sid)
        self.size += len(one)

    def full(self) -> bool:
        return self.size >= CHUNK_SHINGLES or len(self.sets) >= CHUNK_SETS

    def rows(self) -> pa.RecordBatch:
        """A row for each bucket; one of bucket -1 with ids and sizes, one of bucket -2 with the sets of frequent shingles."""
        flat = np.concatenate(self.sets)
        bucket = (flat >> np.uint64(32)) % np.uint64(self.buckets)
        key = bucket << np.uint64(32) | flat & np.uint64(0xFFFFFFFF)
        owner = np.repeat(np.arange(len(self.sets)), [len(s) for s in self.sets]).astype(np.uint16)
        del flat, bucket
        order = np.argsort(key, kind="stable")
        key, owner = key[order], owner[order]
        del order
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        counts = np.diff(np.append(first, len(key)))
        many = np.repeat(counts > LOCAL, counts)
        side = (key[many].tobytes(), owner[many].tobytes(), b"")
        # a frequent shingle is one entry with a count
        stay = ~many
        stay[first] = True
        weight = np.ones(len(key), np.uint32)
        weight[first] = np.where(counts > LOCAL, counts, 1)
        owner = np.where(many, MANY, owner).astype(np.uint16)
        key, owner, weight = key[stay], owner[stay], weight[stay]
        own = key >> np.uint64(32)
        cut = np.searchsorted(own, np.arange(self.buckets + 1, dtype=np.uint64))
        low = key.astype(np.uint32)
        out = [(-1, np.array(self.sids, np.int64).tobytes(), np.array([len(s) for s in self.sets], np.int64).tobytes(), b""), (-2, *side)]
        for b in range(self.buckets):
            at = slice(cut[b], cut[b + 1])
            if cut[b] < cut[b + 1]:
                heavy = np.flatnonzero(weight[at] > 1)
                extra = np.stack((heavy.astype(np.uint32), weight[at][heavy]), 1).tobytes() if len(heavy) else b""
                out.append((b, low[at].tobytes(), owner[at].tobytes(), extra))
        names = [f.split()[0] for f in SENT.split(", ")]
        columns = list(zip(*out, strict=True))
        arrays = [pa.array(columns[0], pa.int64()), pa.array([self.number] * len(out), pa.int64())]
        return pa.RecordBatch.from_arrays([*arrays, *[pa.array(c, pa.binary()) for c in columns[1:]]], names=names)


def sent(docs: DataFrame, words: int, least: int, buckets: int) -> DataFrame:
    """The shingles of all sets of at least ``least``, packed for their buckets."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        chunk = _Chunk(part << 32, buckets)
        for _, sets in _sets(batches, words):
            for one, sid in zip(sets, prints(sets)[:, 0].tolist(), strict=True):
                if len(one) >= least:
                    chunk.add(one, sid)
                    if chunk.full():
                        yield chunk.rows()
                        made += 1
                        chunk = _Chunk(part << 32 | made, buckets)
        if chunk.sets:
            yield chunk.rows()

    return docs.mapInArrow(rows, SENT)


def _shared(table: pa.Table) -> pa.Table:
    """Of one bucket's rows, the shingles that occur again, with a rank for their frequency."""
    shingles = [np.frombuffer(v.as_buffer(), np.uint32) for v in table["shingles"]]
    weights = []
    for own, extra in zip(shingles, table["counts"], strict=True):
        weight = np.ones(len(own), np.uint32)
        pairs = np.frombuffer(extra.as_buffer(), np.uint32).reshape(-1, 2)
        weight[pairs[:, 0]] = pairs[:, 1]
        weights.append(weight)
    flat = np.concatenate(shingles)
    order = np.argsort(flat, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], flat[order][1:] != flat[order][:-1])))
    sums = np.add.reduceat(np.concatenate(weights)[order], first, dtype=np.int64)
    total = np.empty(len(flat), np.int64)
    total[order] = np.repeat(sums, np.diff(np.append(first, len(flat))))
    rank = np.minimum(255, 4 * np.log2(total)).astype(np.uint8)
    out, at = [], 0
    for chunk, own, owners in zip(table["chunk"].to_pylist(), shingles, table["owners"], strict=True):
        keep = np.flatnonzero(total[at : at + len(own)] > 1)
        if len(keep):
            owner = np.frombuffer(owners.as_buffer(), np.uint16)[keep]
            out.append((chunk, table["bucket"][0].as_py(), own[keep].tobytes(), owner.tobytes(), rank[at : at + len(own)][keep].tobytes()))
        at += len(own)
    return _table(out, RARITY)


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.table({name: pa.array(c, kinds[kind]) for (name, kind), c in zip(fields, columns, strict=True)})


def prefixes(percent: int):
    def build(table: pa.Table) -> pa.Table:
        """The prefix entries of one chunk's sets, from the ranks of its shared shingles."""
        sids = sizes = side = None
        keys, owners, ranks = [], [], []
        for bucket, *cells in zip(*[table[c].to_pylist() for c in ("bucket", "shingles", "owners", "ranks")], strict=True):
            if bucket == -1:
                sids, sizes = (np.frombuffer(c, np.int64) for c in cells[:2])
            elif bucket == -2:
                side = np.frombuffer(cells[0], np.uint64), np.frombuffer(cells[1], np.uint16)
            else:
                keys.append(np.frombuffer(cells[0], np.uint32).astype(np.uint64) | np.uint64(bucket << 32))
                owners.append(np.frombuffer(cells[1], np.uint16))
                ranks.append(np.frombuffer(cells[2], np.uint8))
        if not keys or sids is None:
            return _table([], ENTRIES)
        key, owner, rank = map(np.concatenate, (keys, owners, ranks))
        # frequent shingles stand for all their sets in the side table, which is in the order of keys
        many = owner == MANY
        low, high = (np.searchsorted(side[0], key[many], side=s) for s in ("left", "right"))
        count = high - low
        place = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
        key = np.concatenate((key[~many], np.repeat(key[many], count)))
        rank = np.concatenate((rank[~many], np.repeat(rank[many], count)))
        owner = np.concatenate((owner[~many], side[1][place])).astype(np.int64)
        order = np.lexsort((key, rank, owner))
        key, owner = key[order], owner[order]
        shared = np.bincount(owner, minlength=len(sizes))
        before = np.cumsum(shared) - shared
        pos = np.arange(len(owner)) - before[owner] + (sizes - shared)[owner]
        again = np.concatenate(([False], (key[1:] == key[:-1]) & (owner[1:] == owner[:-1])))
        keep = (pos < prefix_length(sizes, percent)[owner]) & ~again
        owner = owner[keep]
        columns = {"key": key[keep].view(np.int64), "sid": sids[owner], "n": sizes[owner], "pos": pos[keep]}
        return pa.table({name: pa.array(c) for name, c in columns.items()})

    return build


def index_entries(docs: DataFrame, words: int, percent: int, least: int, total: int) -> DataFrame:
    """``(key, sid, n, pos)``: the prefixes of the sets of rows ``(doc_id, text)``, each set once or oftener."""
    buckets = max(1, -(-total // BUCKET_SHINGLES))
    packed = durable(sent(docs, words, least, buckets))
    counted = packed.where("bucket >= 0").groupBy("bucket").applyInArrow(_shared, RARITY)
    own = packed.where("bucket < 0").select("chunk", "bucket", "shingles", "owners", F.lit(b"").alias("ranks"))
    return counted.unionByName(own).groupBy("chunk").applyInArrow(prefixes(percent), ENTRIES).distinct()


def room(n: str, pos: str, m: str, other: str, percent: int) -> Column:
    """Whether two sets whose first common shingle is at these positions can be similar."""
    need = F.ceil(F.lit(percent) * (F.col(n) + F.col(m)) / F.lit(100 + percent))
    return F.least(F.col(n) - F.col(pos), F.col(m) - F.col(other)) >= need


def matched_blocks(entries: DataFrame, percent: int) -> DataFrame:
    """The entries whose block of equal size and position has room for a member of its own list."""
    blocks = durable(entries.groupBy("key", "n", "pos").agg(F.count(F.lit(1)).alias("members")))
    other = blocks.select("key", F.col("n").alias("m"), F.col("pos").alias("q"))
    same = (F.col("n") == F.col("m")) & (F.col("pos") == F.col("q"))
    met = blocks.join(other, "key").where(room("n", "pos", "m", "q", percent) & (~same | (F.col("members") > 1)))
    return entries.join(met.select("key", "n", "pos").distinct(), ["key", "n", "pos"], "left_semi")


COMPARED = "a long, b long, common long, less binary, more binary"


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """For pairs ``(a, b)`` the number of common shingles, and those of ``a`` that ``b`` lacks and the reverse.

    The set of ``a`` is shipped once for a page of its pairs.
    """
    counts = durable(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("pairs")))
    page = F.pmod(F.xxhash64("b"), F.ceil(F.col("pairs") / PAGE)).alias("page")
    paged = lookup(pairs, counts, "a", "pairs", written=True).select("a", "b", page)
    left = paged.select("a", "page").distinct().join(sets.select(F.col("sid").alias("a"), F.col("hashes").alias("ha")), "a")
    right = paged.join(sets.select(F.col("sid").alias("b"), F.col("hashes").alias("hb")), "b")
    met = right.join(left, ["a", "page"]).select("a", "b", "ha", "hb")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common, less, more = [], [], []
            for at in range(batch.num_rows):
                a, b = (np.frombuffer(batch.column(c)[at].as_buffer(), np.uint64) for c in (2, 3))
                inside = np.isin(a, b, assume_unique=True)
                common.append(int(inside.sum()))
                less.append(a[~inside].tobytes())
                more.append(np.setdiff1d(b, a, assume_unique=True).tobytes())
            arrays = [batch.column(0), batch.column(1), pa.array(common, pa.int64()), pa.array(less, pa.binary()), pa.array(more, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["a", "b", "common", "less", "more"])

    return met.mapInArrow(rows, COMPARED)


def derived(pairs: DataFrame, answers: DataFrame) -> DataFrame:
    """For pairs ``(a, b, lead, lead_n)`` with a common leader the number of common shingles, from their differences."""
    def side(name: str, less: str, more: str) -> DataFrame:
        return answers.select(F.col("sid").alias(name), "lead", F.col("less").alias(less), F.col("more").alias(more))

    met = pairs.join(side("a", "la", "ma"), ["a", "lead"]).join(side("b", "lb", "mb"), ["b", "lead"])
    met = met.select("a", "b", "lead_n", "la", "lb", "ma", "mb")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common = []
            for at in range(batch.num_rows):
                la, lb, ma, mb = (np.frombuffer(batch.column(c)[at].as_buffer(), np.uint64) for c in range(3, 7))
                gone = len(la) + len(lb) - len(np.intersect1d(la, lb, assume_unique=True))
                common.append(batch.column(2)[at].as_py() - gone + len(np.intersect1d(ma, mb, assume_unique=True)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(common, pa.int64())], names=["a", "b", "common"])

    return met.mapInArrow(rows, "a long, b long, common long")


def similar(common: str | Column, n: str, m: str, percent: int) -> Column:
    common = F.col(common) if isinstance(common, str) else common
    return F.lit(100 + percent) * common >= F.lit(percent) * (F.col(n) + F.col(m))


def open_answer(percent: int):
    """Whether a leader ``p_`` has to look at a member of a block: it is another one, neither led the other before, and the
    answers of a leader of both do not rule the pair out."""

    def open_to(m: Column) -> Column:
        related = F.coalesce(m["lead"] == F.col("p_lead"), F.lit(False))
        most = F.least(
            m["with_lead"] + F.col("p_n") - F.col("p_with_lead"), F.col("p_with_lead") + F.col("n") - m["with_lead"]
        )
        known = m["lead"].eqNullSafe(F.col("p_sid")) | F.col("p_lead").eqNullSafe(m["sid"])
        return (m["sid"] != F.col("p_sid")) & ~known & (~related | similar(most, "n", "p_n", percent))

    return open_to


def set_links(entries: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` between the documents of sets that connect all that are similar.

    ``entries`` is ``(key, sid, n, pos, rep)``, ``rep`` the document of a set.
    """
    spark = entries.sparkSession
    plain = ["key", "sid", "n", "pos", "rep", "comp"]
    known = ["lead", "lead_n", "with_lead"]
    nothing = [F.lit(None).cast("long").alias(c) for c in known]
    active = durable(entries.select("*", F.col("rep").alias("comp"), *nothing))
    answers = spark.createDataFrame([], "sid long, lead long, lead_n long, with_lead long, less binary, more binary")
    found = [spark.createDataFrame([], "a long, b long")]
    salts = 1
    while not active.isEmpty():
        salt = F.pmod(F.xxhash64("sid"), F.lit(salts))
        member = F.struct("sid", "rep", *known)
        # the fewer rarer shingles, the closer to the middle of a group of similar sets
        leaders = durable(
            active.groupBy("key", salt.alias("salt")).agg(F.min(F.struct("pos", "n", "sid", "rep", "comp", *known)).alias("p"))
            .select("key", *[F.col(f"p.{c}").alias(f"p_{c}") for c in ("pos", "n", "sid", "rep", "comp", *known)])
        )
        # blocks of one component each, so that a leader skips those of its own without looking at their members
        cut = ["key", "n", "pos", "comp"]
        most = active.groupBy(*cut).count().agg(F.max("count")).first()[0]
        page = F.pmod(F.xxhash64("sid"), F.lit(-(-most // PAGE)))
        blocks = active.groupBy(*cut, page.alias("page")).agg(F.collect_list(member).alias("members"))
        near = (blocks["key"] == leaders["key"]) & (F.col("comp") != F.col("p_comp")) & room("n", "pos", "p_n", "p_pos", percent)
        led_by = [c for c in leaders.columns if c != "key"]
        met = blocks.join(leaders, near).select("n", "comp", *led_by, F.filter("members", open_answer(percent)).alias("members"))
        met = met.select("n", "comp", *led_by, F.inline("members"))
        related = F.coalesce(F.col("lead") == F.col("p_lead"), F.lit(False))
        certain = F.col("with_lead") + F.col("p_with_lead") - F.col("lead_n")
        pairs = met.select(
            F.col("p_sid").alias("a"), F.col("sid").alias("b"), F.col("p_n").alias("na"), F.col("n").alias("nb"),
            F.col("p_rep").alias("ra"), F.col("rep").alias("rb"), F.col("p_comp").alias("ca"), F.col("comp").alias("cb"),
            F.when(related, F.col("lead")).alias("lead"), F.when(related, F.col("lead_n")).alias("lead_n"),
            F.when(related, certain).alias("certain"),
        )
        pairs = durable(pairs.dropDuplicates(["a", "b"]))
        sure = F.coalesce(similar("certain", "na", "nb", percent), F.lit(False))
        open_pairs = pairs.where(~sure)
        whole = durable(compared(open_pairs.where(F.col("lead").isNull()).select("a", "b"), sets))
        short = derived(open_pairs.where(F.col("lead").isNotNull()).select("a", "b", "lead", "lead_n"), answers)
        common = whole.select("a", "b", "common").unionByName(short)
        new = pairs.where(sure).select("ra", "rb", "ca", "cb").unionByName(
            pairs.join(common, ["a", "b"]).where(similar("common", "na", "nb", percent)).select("ra", "rb", "ca", "cb")
        )
        new = durable(new)
        led = leaders.select("key", F.col("p_sid").alias("sid"))
        active = active.join(led, ["key", "sid"], "left_anti")
        if not new.isEmpty():
            found.append(new.select(F.col("ra").alias("a"), F.col("rb").alias("b")))
            joined = components(new.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
            active = active.join(joined.select(F.col("id").alias("comp"), F.col("component").alias("_new")), "comp", "left")
            active = active.withColumn("comp", F.coalesce("_new", "comp")).drop("_new")
        open_keys = active.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        active = active.join(open_keys.where(F.col("lo") != F.col("hi")).select("key"), "key", "left_semi")
        # the most similar leader's answer stays with a set for later rounds
        sizes = pairs.select("a", "b", F.col("na").alias("lead_n"), F.col("nb").alias("n"))
        fresh = whole.join(sizes, ["a", "b"]).where(similar("common", "lead_n", "n", percent - 10))
        fresh = fresh.select(F.col("b").alias("sid"), F.col("a").alias("lead"), "lead_n", F.col("common").alias("with_lead"), "less", "more")
        best = F.max_by(F.struct(*known, "less", "more"), F.struct("with_lead", "lead")).alias("best")
        answers = durable(answers.unionByName(fresh).groupBy("sid").agg(best).select("sid", "best.*"))
        active = durable(active.select(*plain).join(answers.select("sid", *known), "sid", "left").select(*plain, *known))
        salts *= GROWTH
    return reduce(DataFrame.unionByName, found)


def linked(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of each row: documents are linked where the intersection of their shingle sets is
    at least ``percent`` (51 to 99) hundredths of the union; the component is the smallest id that links lead to."""
    own = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    sets = durable(sized(own, words))
    named = sets.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    content = ["n", "f1", "f2"]
    heads = durable(named.groupBy(*content).agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("rows")))
    # a smaller set has no other one within the threshold
    least = -(-percent // (100 - percent))
    total = heads.where(F.col("n") >= least).agg(F.sum("n")).first()[0] or 0
    ids = heads.select(F.col("id").alias("doc_id")).distinct()
    copies = durable(named.select("doc_id").distinct().join(ids, "doc_id", "left_anti"))
    own = own.where(F.col("doc_id").isNotNull())
    if copies.count() <= BROADCAST_IDS:
        singles = own.join(F.broadcast(copies), "doc_id", "left_anti")
    else:
        singles = durable(own.join(copies, "doc_id", "left_anti"))
    entries = index_entries(singles, words, percent, least, total)
    reps = heads.select(F.col("f1").alias("sid"), F.col("id").alias("rep")).groupBy("sid").agg(F.min("rep").alias("rep"))
    entries = durable(matched_blocks(durable(entries), percent).join(reps, "sid").select("key", "sid", "n", "pos", "rep"))
    wanted = durable(entries.select(F.col("rep").alias("doc_id")).distinct())
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    whole = durable(whole_sets(singles.join(wanted, "doc_id", "left_semi"), words))
    links = set_links(entries, whole, percent)
    # rows with one id but different sets are one document
    same = lookup(named, heads.select(*content, "id", "rows"), content, "rows", written=True)
    links = links.unionByName(same.select(F.col("doc_id").alias("a"), F.col("id").alias("b")))
    component = components(links).withColumnRenamed("id", "doc_id")
    return sets.join(component, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )
