"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's set is the hashes (64 bits) of its distinct word n-grams. Documents
with equal sets form a class, named by a 128-bit digest; everything below is on
classes, so copies never make pairs.

One order of all n-grams is fixed: first n-grams whose hash is in the lowest
``counted`` share and that few documents have, by hash; then those that many
documents have; then the rest. If two sets of sizes a and b overlap enough for
the threshold, the first ``a - ceil(t a) + l`` of one and the first
``b - ceil(t b) + l`` of the other share at least l n-grams, for every l. Each
document chooses its own l: a share of its basic prefix, and more if hashing met
common n-grams, whose lists would cost most to go through. A pair must share the
lesser l of the two before it counts as a candidate.

Lists of at most ``list_bound`` classes are paired; a longer list (only sets made
almost wholly of common n-grams have those) ties its classes to a node that
stands for the n-gram. Components of that candidate graph are clusters; each
class's whole set goes to its cluster (a third reading of the texts), where exact
overlaps are counted by matrix products, block against block, and a spanning forest
of the exact links comes out. In a large cluster only blocks of sets whose sizes
allow a link meet. So pairs within a group are never listed, and no link is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.common import cut, join_groups, keep, ready
from tidemark.llm.components import components
from tidemark.llm.textblocks import mix, shingle_sets, slices

#: Classes on a side of one block of a cluster.
CLUSTER_BLOCK = 512


def _digest(tokens: np.ndarray) -> bytes:
    """128 bits over a sorted set."""
    return np.array([len(tokens) and int(np.add.reduce(mix(tokens ^ np.uint64(k)))) for k in (0x243F6A88, 0x85A308D3)], np.uint64).tobytes()


def _short(digest: bytes) -> int:
    """64 bits of a class's name, as a long. Candidates go by these: classes that share one only share a cluster."""
    return int.from_bytes(digest[:8], "big", signed=True)


class Bits:
    """A set of 64-bit hashes as a bit table of 2^k places; it may also say yes to others."""

    def __init__(self, table: np.ndarray) -> None:
        self.table = table
        self.mask = np.uint64(len(table) * 8 - 1)

    def has(self, tokens: np.ndarray) -> np.ndarray:
        place = mix(tokens) & self.mask
        return (self.table[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _order(tokens: np.ndarray, common: np.ndarray, counted: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Permutation of a sorted set into the order of all n-grams; which of the permuted are common."""
    low = int(np.searchsorted(tokens, counted))
    hot = np.zeros(low, bool)
    if len(common) and low:
        at = np.searchsorted(common, tokens[:low])
        at[at == len(common)] = 0
        hot = common[at] == tokens[:low]
    order = np.concatenate([np.flatnonzero(~hot), np.flatnonzero(hot), np.arange(low, len(tokens))])
    flags = np.zeros(len(tokens), bool)
    flags[:low] = hot
    return order, flags


def _basic(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _least_level(n: int, percent: int) -> int:
    """The least l that any partner of a set of n may have (partners have percent of n at least)."""
    return 1 + _basic(-(-percent * n // 100), percent) // 4


def _prefix(tokens: np.ndarray, common: np.ndarray, counted: np.uint64, percent: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The prefix, which of it are in common lists, and l."""
    n = len(tokens)
    basic = _basic(n, percent)
    order, hot = _order(tokens, common, counted)
    met = int(hot[:basic].sum())
    level = 1 + basic // 4 + met // 2
    level = min(level, n - basic + 1)
    chosen = order[: basic - 1 + level]
    return tokens[chosen], hot[chosen], level


def link_components(docs: DataFrame, size: int = 4, percent: int = 85, counted: float = 0.35, common_bound: int = 1 << 20, list_floor: int = 32, seen_bits: int = 1 << 27, id_type: str | None = "long") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Two documents link when 100 x intersection >= percent x union; a component's
    id is its least doc_id. Defined cases: null and empty texts and texts of
    white space have no n-grams and link with nothing (component_id is the own
    doc_id); a text with fewer words than ``size`` has its whole sequence as one
    n-gram; null ids take part, yet never name a component that has another id;
    repeated rows are copies; an empty table gives no rows; other columns are
    ignored. ``common_bound`` bounds the broadcast list of common n-grams and
    ``seen_bits`` the broadcast bit table; both only steer the work. With
    ``id_type`` None ids are taken as they are, of any ordered type.
    """
    spark = docs.sparkSession
    ready(spark)
    edge = np.uint64(int(counted * (1 << 64)))
    texts = docs.select((F.col("doc_id").cast(id_type) if id_type else F.col("doc_id")).alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    named = T.StructType([texts.schema["doc_id"], T.StructField("n", T.LongType()), T.StructField("cls", T.BinaryType())])

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, offsets in slices(batch, "text"):
                sets = list(shingle_sets(raw, offsets, size))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([_digest(s) for s in sets], pa.binary())], names=["doc_id", "n", "cls"])

    def low(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, raw, offsets in slices(batch, "text"):
                found = [s[: np.searchsorted(s, edge)] for s in shingle_sets(raw, offsets, size)]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["token"])

    # pass 1: classes, and in how many documents each counted n-gram is
    rows = cut(texts.mapInArrow(classes, named))
    tokens = texts.select("text").mapInArrow(low, "token long")
    df = keep(tokens.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1"))
    shared = df.agg(F.sum("df")).first()[0] or 0
    list_bound = max(list_floor, -(-shared // common_bound))
    common = np.sort(df.filter(F.col("df") > list_bound).select("token").toArrow().column("token").to_numpy().view(np.uint64))
    seen = spark.sparkContext.broadcast((common, _bit_table(df, seen_bits)))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, bits = seen.value[0], Bits(seen.value[1])
        sent: set[bytes] = set()
        for batch in batches:
            for part, raw, offsets in slices(batch, "text"):
                cls, n, level, lists, hots = [], [], [], [], []
                for s in shingle_sets(raw, offsets, size):
                    name = _digest(s)
                    if not len(s) or name in sent:
                        continue
                    if len(sent) < 100_000:
                        sent.add(name)
                    some, hot, l = _prefix(s, common, edge, percent)
                    # n-grams of the counted share that only one document has can match nothing
                    may = (some >= edge) | bits.has(some)
                    if may.sum() >= min(l, _least_level(len(s), percent)):
                        cls.append(_short(name))
                        n.append(len(s))
                        level.append(l)
                        lists.append(some[may].view(np.int64))
                        hots.append(hot[may])
                if cls:
                    yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(n, pa.int32()), pa.array(level, pa.int32()), pa.array(lists, pa.list_(pa.int64())), pa.array([h.tolist() for h in hots], pa.list_(pa.bool_()))], names=["cls", "n", "level", "tokens", "hot"])

    # pass 2: prefixes, one row per class that may have a partner
    second = cut(texts.mapInArrow(prefixes, "cls long, n int, level int, tokens array<long>, hot array<boolean>").dropDuplicates(["cls", "n", "tokens"]))
    lists = second.select("cls", "n", "level", F.explode(F.arrays_zip("tokens", "hot")).alias("_t")).select("cls", "n", "level", F.col("_t.tokens").alias("token"), F.col("_t.hot").alias("hot"))
    nodes = lists.filter("hot").select(F.col("cls").alias("a"), F.col("token").alias("b"))
    candidates = _candidates(lists.filter(~F.col("hot")).drop("hot"), list_bound, percent)
    clusters = components(candidates.unionByName(nodes))
    return _name(rows, components(_links(texts, size, second.select("cls", "n"), clusters, percent, seen_bits)))


def _bit_table(df: DataFrame, most: int) -> np.ndarray:
    """Bit table over the n-grams of ``df``, with at least 16 places each up to ``most`` bits (16 MB)."""
    places = min(most, 1 << max(17, (16 * max(1, df.count()) - 1).bit_length()))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where = (mix(batch.column("token").to_numpy().view(np.uint64)) & np.uint64(places - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(where)], names=["place"])

    per = 32768
    maps = df.select("token").mapInArrow(fill, "place long").groupBy(F.floor(F.col("place") / per).alias("m")).agg(F.bitmap_construct_agg(F.pmod("place", F.lit(per))).alias("bits"))
    table = np.zeros(places // 8, np.uint8)
    for m, bits in maps.toLocalIterator():
        table[m * per // 8 : (m + 1) * per // 8] = np.frombuffer(bits, np.uint8)[: len(table)]
    return table


def _candidates(lists: DataFrame, list_bound: int, percent: int) -> DataFrame:
    """Edges (a, b): pairs of classes that share enough prefix n-grams, and long lists' ties to their n-gram."""
    sorted_lists = lists.repartition("token").sortWithinPartitions("token", "cls")

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        token, long = None, False
        pairs: dict[tuple[int, int], list[int]] = {}
        ties: list[tuple[int, int]] = []

        def close() -> None:
            if long:
                return
            for i, (x, n, l) in enumerate(held):
                for y, m, k in held[i + 1 :]:
                    if 100 * min(n, m) >= percent * max(n, m):
                        pairs.setdefault((x, y), [0, min(l, k)])[0] += 1

        def out(least: int) -> Iterator[pa.RecordBatch]:
            if len(pairs) + len(ties) > least:
                a = [p[0] for p in pairs] + [t[0] for t in ties]
                b = [p[1] for p in pairs] + [t[1] for t in ties]
                hits = [v[0] for v in pairs.values()] + [1] * len(ties)
                need = [v[1] for v in pairs.values()] + [0] * len(ties)
                pairs.clear()
                ties.clear()
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(hits, pa.int64()), pa.array(need, pa.int64())], names=["a", "b", "hits", "need"])

        for batch in batches:
            for cls, n, l, t in zip(*(batch.column(c).to_pylist() for c in ("cls", "n", "level", "token"))):
                if t != token:
                    close()
                    held, token, long = [], t, False
                    yield from out(100_000)
                if not long and len(held) >= list_bound:
                    long = True
                    ties.extend((x[0], t) for x in held)
                    held = []
                if long:
                    ties.append((cls, t))
                else:
                    held.append((cls, n, l))
        close()
        yield from out(0)

    found = sorted_lists.mapInArrow(pair, "a long, b long, hits long, need long")
    return found.groupBy("a", "b").agg(F.sum("hits").alias("hits"), F.max("need").alias("need")).filter("hits >= need").select("a", "b")


def _links(texts: DataFrame, size: int, classes: DataFrame, clusters: DataFrame, percent: int, seen_bits: int) -> DataFrame:
    """Edges (a, b) of a forest that spans every component of the exact links.

    Pass 3 over the texts: only sets of classes in clusters are sent, which a
    broadcast bit table tells, each once a task.
    """
    # n-grams that stand for long lists are vertices too; only classes have sets
    members = clusters.select(F.col("vertex").alias("short"), "root").join(classes.select(F.col("cls").alias("short"), "n").distinct(), "short")
    # sets of linked classes differ in size by less than a band's width or by one band
    width = math.log(100 / min(percent, 99)) + 1e-9
    members = members.withColumn("_band", F.floor(F.log(F.col("n").cast("double")) / width).cast("int"))
    sizes = members.groupBy("root", "_band").agg(F.count("*").alias("_c"))
    near = sizes.select("root", "_c", F.explode(F.array(*(F.struct((F.col("_band") - d).alias("_band"), F.lit(d).alias("d")) for d in (-1, 0, 1)))).alias("_n")).select("root", "_c", "_n.*")
    counted = lambda d: F.coalesce(F.sum(F.when(F.col("d") == d, F.col("_c"))), F.lit(0))
    near = near.groupBy("root", "_band").agg(counted(-1).alias("_below"), counted(0).alias("_size"), counted(1).alias("_above")).filter("_size > 0")
    whole = sizes.groupBy("root").agg(F.sum("_c").alias("_all")).filter("_all > 1")
    members = cut(join_groups(join_groups(members, whole, "root"), near.withColumnRenamed("root", "_r").withColumnRenamed("_band", "_b"), (F.col("root") == F.col("_r")) & (F.col("_band") == F.col("_b"))).drop("_r", "_b"))
    table = _bit_table(members.select(F.col("short").alias("token")), seen_bits)
    wanted = texts.sparkSession.sparkContext.broadcast(table)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, sent = Bits(wanted.value), set()
        for batch in batches:
            for _, raw, offsets in slices(batch, "text"):
                found = {_digest(s): s for s in shingle_sets(raw, offsets, size) if len(s)}
                first = np.array([_short(name) for name in found], np.int64).view(np.uint64)
                out = [(name, _short(name), s.tobytes()) for (name, s), w in zip(found.items(), bits.has(first)) if w and name not in sent]
                if len(sent) < 100_000:
                    sent.update(o[0] for o in out)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.binary())], names=["cls", "short", "set"])

    members = texts.select("text").mapInArrow(sets, "cls binary, short long, set binary").join(members, "short").dropDuplicates(["short", "cls"])
    # a small cluster is one meeting; of a large one, blocks of one band meet, and those of a band with the next band's
    blocks = {c: F.ceil(F.col(c) / CLUSTER_BLOCK).cast("int") for c in ("_below", "_size", "_above")}
    own = lambda c: F.pmod(F.xxhash64("cls"), F.greatest(blocks[c], F.lit(1))).cast("int")
    place = lambda band, kind, i, j: F.struct(band.alias("band"), F.lit(kind).alias("kind"), i.cast("int").alias("i"), j.cast("int").alias("j"))
    each = lambda c, f: F.when(blocks[c] > 0, F.transform(F.sequence(F.lit(0), F.greatest(blocks[c], F.lit(1)) - 1), f)).otherwise(F.array().cast("array<struct<band:int,kind:int,i:int,j:int>>"))
    mine, band = own("_size"), F.col("_band")
    many = F.concat(each("_size", lambda o: place(band, 0, F.least(mine, o), F.greatest(mine, o))), each("_above", lambda o: place(band, 1, mine, o)), each("_below", lambda o: place(band - 1, 1, o, mine)))
    zero = F.lit(0)
    members = members.withColumn("_at", F.explode(F.when(F.col("_all") <= CLUSTER_BLOCK, F.array(place(F.lit(-1), 0, zero, zero))).otherwise(many)))
    members = members.select("root", "_at.*", "cls", "set")
    meetings = members.repartition("root", "band", "kind", "i", "j").sortWithinPartitions("root", "band", "kind", "i", "j")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, names, held = None, [], []
        found: list[tuple[bytes, bytes]] = []

        def out(least: int) -> Iterator[pa.RecordBatch]:
            if len(found) > least:
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.binary())], names=["a", "b"])
                found.clear()

        for batch in batches:
            for *meeting, cls, raw in zip(*(batch.column(c).to_pylist() for c in ("root", "band", "kind", "i", "j", "cls", "set"))):
                if meeting != key:
                    found += _forest(names, held, percent)
                    key, names, held = meeting, [], []
                    yield from out(10_000)
                names.append(cls)
                held.append(np.frombuffer(raw, np.uint64))
        found += _forest(names, held, percent)
        yield from out(0)

    return meetings.mapInArrow(verify, "a binary, b binary")


def _forest(names: list[bytes], sets: list[np.ndarray], percent: int, columns: int = 4096) -> list[tuple[bytes, bytes]]:
    """Spanning forest of the exact links among a few sets."""
    m = len(names)
    if m < 2:
        return []
    sizes = np.array([len(s) for s in sets])
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(m), sizes)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    new = np.ones(len(tokens), bool)
    new[1:] = tokens[1:] != tokens[:-1]
    column = np.cumsum(new) - 1
    often = np.bincount(column)[column] > 1
    column, owner = column[often], owner[often]
    column = np.unique(column, return_inverse=True)[1]
    common = np.zeros((m, m), np.float32)
    start, last = 0, int(column[-1]) + 1 if len(column) else 0
    for c in range(0, last, columns):
        stop = int(np.searchsorted(column, c + columns))
        dense = np.zeros((m, min(columns, last - c)), np.float32)
        dense[owner[start:stop], column[start:stop] - c] = 1
        common += dense @ dense.T
        start = stop
    both = sizes[:, None] + sizes[None, :]
    linked = np.triu(100 * common.astype(np.int64) >= percent * (both - common.astype(np.int64)), 1)
    label, out = list(range(m)), []

    def find(v: int) -> int:
        while label[v] != v:
            label[v] = label[label[v]]
            v = label[v]
        return v

    for x, y in zip(*(v.tolist() for v in np.nonzero(linked))):
        a, b = find(x), find(y)
        if a != b:
            label[b] = a
            out.append((names[x], names[y]))
    return out


def _name(rows: DataFrame, linked: DataFrame) -> DataFrame:
    """Documents with the least doc_id of their component."""
    per = rows.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("_first"))
    per = cut(per.join(linked.withColumnRenamed("vertex", "cls"), "cls", "left"))
    # only classes with links need another's id
    tied = per.filter("root IS NOT NULL")
    tied = join_groups(tied.select("cls", "root"), tied.groupBy("root").agg(F.min("_first").alias("component_id")), "root").select("cls", "component_id")
    alone = per.filter("root IS NULL").select("cls", F.col("_first").alias("component_id"))
    full = join_groups(rows.filter("n > 0"), alone.unionByName(tied), "cls")
    empty = rows.filter("n = 0").withColumn("component_id", F.col("doc_id"))
    return full.select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(empty.select("doc_id", F.col("n").alias("n_shingles"), "component_id"))


#: Pairs that share an n-gram are counted, which only a small table bears.
ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT r, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [hash(w)]
                                 ELSE list_transform(range(1, len(w) - 2), lambda i: hash(w[i:i+3])) END) AS g
  FROM w),
c AS (SELECT r, count(*) AS n FROM s GROUP BY r),
i AS (SELECT x.r AS a, y.r AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.r < y.r GROUP BY 1, 2),
l AS (
  SELECT a, b FROM i JOIN c ca ON ca.r = a JOIN c cb ON cb.r = b WHERE 100 * k >= 85 * (ca.n + cb.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
t(r, q) AS (SELECT r, r FROM w UNION SELECT t.r, e.b FROM t JOIN e ON e.a = t.q)
SELECT w.doc_id, coalesce(c.n, 0) AS n_shingles, (SELECT min(o.doc_id) FROM t JOIN w o ON o.r = t.q WHERE t.r = w.r) AS component_id
FROM w LEFT JOIN c ON c.r = w.r
"""
