"""URL filter rules by a sort-merge range join on reversed hosts.

A host's canonical key is its labels reversed, each followed by a dot
(``www.example.org`` is ``org.example.www.``). A rule's host and all its
subdomains are then exactly the keys in the interval from its own key up to that
key with the last dot made a slash, and intervals either nest or are apart.
URLs and rules are dealt into ranges of the key; each range is swept in order of
the key with a stack of the rules' intervals that are open, and every URL
asks the open hosts for their longest fitting path.

Range borders come from a sample of some 20,000 URL keys and affect balance alone. A
host that fills several ranges is dealt over all of them by the page's hash, and
rules are copied to every range that their interval meets.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import keep, ready, uniform

#: Fixed by the contract: host, path, verdict.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: URLs of one range, about.
RANGE_ROWS = 1_000_000
#: The verdict where no rule fits.
OTHERWISE = "allow"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def key_of(host: Column) -> Column:
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def end_of(key: str) -> str:
    """The least string after all that begin with a key."""
    return key[:-1] + "/"


class Open:
    """The rules of one open host: by path length, the paths and what they say."""

    def __init__(self, end: str, host: str) -> None:
        self.end, self.host = end, host
        self.paths: dict[str, str] = {}
        self.lengths: list[int] = []

    def add(self, path: str, verdict: str) -> None:
        # of equal rules with unlike verdicts the block holds
        self.paths[path] = "block" if "block" in (verdict, self.paths.get(path)) else verdict
        self.lengths = sorted({len(p) for p in self.paths}, reverse=True)

    def longest(self, path: str) -> str | None:
        return next((path[:n] for n in self.lengths if n <= len(path) and path[:n] in self.paths), None)


class Sweep:
    """Rules and URLs in order of (key, rules first); keeps a stack of nested open hosts."""

    def __init__(self) -> None:
        self.stack: list[Open] = []

    def advance(self, key: str) -> None:
        while self.stack and not key < self.stack[-1].end:
            self.stack.pop()

    def rule(self, key: str, host: str, path: str, verdict: str) -> None:
        self.advance(key)
        if not self.stack or self.stack[-1].host != host:
            self.stack.append(Open(end_of(key), host))
        self.stack[-1].add(path, verdict)

    def judge(self, key: str, path: str) -> tuple[str, str] | None:
        """The rule and verdict of the longest rule; of equals, the one with the longer host."""
        self.advance(key)
        best = None
        for level in self.stack:
            fit = level.longest(path)
            if fit is not None and (best is None or len(level.host) + len(fit) >= len(best[0])):
                best = level.host + fit, level.paths[fit]
        return best


def judge_urls(pages: DataFrame, rules: DataFrame, otherwise: str = OTHERWISE, ranges: int | None = None, sample_rows: int = 20_000) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    ``rules`` has host, path and verdict (allow or block). A rule fits its host
    and all subdomains where the path starts with the rule's; the longest
    rule, host and path together, wins, then the one with the longer host, then
    block. Defined cases: a null url or one without :// has an empty host and
    path and fits no rule; rules with a null or empty host are ignored, a null
    path counts as empty; repeated rows are judged alike; an empty table of pages
    gives no rows, and without rules every verdict is ``otherwise``; other
    columns are ignored.
    """
    spark = pages.sparkSession
    ready(spark)
    url = F.col("url").cast("string")
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    urls = keep(urls.withColumn("key", key_of(F.col("host"))))
    count = urls.count()
    ranges = ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // RANGE_ROWS))
    # an even share of the rows by hash: about sample_rows of them, and all where there are fewer
    share = uniform(F.lit(5), F.col("page_id"), F.col("key"), F.monotonically_increasing_id()) < sample_rows / max(1, count)
    sampled = sorted(r[0] for r in urls.filter(share).select("key").toLocalIterator())
    borders = [sampled[len(sampled) * k // ranges] for k in range(1, ranges)] if sampled else []

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = []
            for key, h in zip(batch.column("key").to_pylist(), batch.column("h").to_pylist()):
                lo, hi = bisect_left(borders, key), bisect_right(borders, key)
                at.append(lo + h % (hi - lo + 1))
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *(batch.column(c) for c in ("page_id", "host", "path", "key"))], names=["at", "page_id", "host", "path", "key"])

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            out = [{"at": at, **r} for r in rows for at in range(bisect_left(borders, r["key"]), bisect_left(borders, end_of(r["key"])) + 1)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([o["at"] for o in out], pa.int32()), *(pa.array([o[c] for o in out], pa.string()) for c in ("host", "path", "key", "verdict"))], names=["at", "host", "path", "key", "verdict"])

    kind = "at int, page_id long, host string, path string, key string"
    dealt = urls.select("page_id", "host", "path", "key", F.pmod(F.xxhash64("page_id"), F.lit(1 << 30)).alias("h")).mapInArrow(deal, kind)
    wanted = rules.select(F.translate(F.col("host").cast("string"), _UPPER, _LOWER).alias("host"), F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"), "verdict").filter("host <> ''").distinct()
    copied = wanted.withColumn("key", key_of(F.col("host"))).mapInArrow(copy, "at int, host string, path string, key string, verdict string")
    both = dealt.withColumns({"kind": F.lit(1), "verdict": F.lit(None).cast("string")}).unionByName(copied.withColumns({"kind": F.lit(0), "page_id": F.lit(None).cast("long")}))
    # a range is a partition: hashed numbers would put several in one and leave others empty
    swept = both.repartitionById(ranges, F.col("at")).sortWithinPartitions("at", "key", "kind")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, now = Sweep(), None
        for batch in batches:
            out: list[tuple] = []
            columns = (batch.column(c).to_pylist() for c in ("at", "kind", "page_id", "host", "path", "key", "verdict"))
            for at, kind, page, host, path, key, verdict in zip(*columns):
                if at != now:
                    state, now = Sweep(), at
                if kind == 0:
                    state.rule(key, host, path, verdict)
                else:
                    rule, said = state.judge(key, path) or (None, otherwise)
                    out.append((page, host, path, rule, said))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), *[pa.string()] * 4))], names=["page_id", "host", "path", "rule", "verdict"])

    return swept.mapInArrow(sweep, "page_id long, host string, path string, rule string, verdict string")


def fixed_rules(pages: DataFrame) -> DataFrame:
    return pages.sparkSession.createDataFrame(list(RULES), "host string, path string, verdict string")


ORACLE_SQL = r"""
WITH u AS (
  SELECT page_id,
         CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN NULL
              ELSE substr(url, strpos(url, '://') + 3) END AS tail
  FROM pages),
p AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(tail, '^[^/?#]*'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(tail, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM u),
r(rhost, rpath, rverdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
f AS (
  SELECT page_id, rhost || rpath AS rule, rverdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC, length(rhost) DESC, rverdict DESC) AS k
  FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT p.page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict
FROM p LEFT JOIN f ON p.page_id = f.page_id AND k = 1
"""
