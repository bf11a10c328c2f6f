"""URL filters: a sort-merge range join of URLs with nested host and path rules.

A host is turned round into labels that each end in a slash (`www.example.org`
becomes `org/example/www/`; no host holds a slash), so that a rule's host and
all its subdomains are one interval of the sort order and intervals of
different rules are nested or apart.  URLs and rules are dealt to ranges of
(turned host, path, hash of the row), one task a range, a rule to each range
that its interval meets, and sorted by host; one sweep over a range keeps a
stack of the hosts whose intervals are open.  A rule for a host and a path is an
interval in two dimensions, as subdomains lie between the host's own paths, so
paths are no part of the sweep: each open host has its own sorted with links to
the longest shorter path that begins them, and the longest path rule is one
bisection and a walk.  What a URL's length costs is its own comparisons.
"""

from __future__ import annotations

from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows looked at for each range when its border is chosen; borders only shape the work.
SAMPLE = 60

# The contract's rules as (verdict, host, path).
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def host_of(url):
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url):
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def turned(host):
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "/"), F.lit("/")))


def rules_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame([(v, h, p) for v, h, p in rules], "verdict string, host string, path string")


class _Host:
    """Path rules of one open host."""

    def __init__(self, turn: str):
        self.turn, self.rules, self.paths, self.shorter = turn, {}, None, None

    def add(self, path: str, rule: str, verdict: str) -> None:
        self.paths = None
        if path not in self.rules or verdict == "block":
            self.rules[path] = (rule, verdict)

    def longest(self, path: str):
        if self.paths is None:
            self.paths, self.shorter, open_ = sorted(self.rules), [], []
            for k, p in enumerate(self.paths):
                while open_ and not p.startswith(self.paths[open_[-1]]):
                    open_.pop()
                self.shorter.append(open_[-1] if open_ else -1)
                open_.append(k)
        k = bisect_right(self.paths, path) - 1
        while k >= 0 and not path.startswith(self.paths[k]):
            k = self.shorter[k]
        return self.rules[self.paths[k]] if k >= 0 else None


def _sweep(default: str, names: list[str]):
    def run(batches):
        at, stack = None, []
        for batch in batches:
            rules, verdicts, keep = [], [], []
            parts, turns, kinds, paths = (batch.column(c).to_pylist() for c in ("_part", "_turned", "_kind", "_path"))
            rule_names, given = batch.column("_rule").to_pylist(), batch.column("_verdict").to_pylist()
            for k, (part, turn, kind, path) in enumerate(zip(parts, turns, kinds, paths)):
                if part != at:
                    at, stack = part, []
                while stack and not turn.startswith(stack[-1].turn):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1].turn != turn:
                        stack.append(_Host(turn))
                    stack[-1].add(path, rule_names[k], given[k])
                    continue
                best = None
                for host in reversed(stack):
                    found = host.longest(path)
                    if found and (best is None or len(found[0]) > len(best[0])):
                        best = found
                keep.append(k)
                rules.append(best[0] if best else None)
                verdicts.append(best[1] if best else default)
            rows = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in names), rows.column("_host"), rows.column("_path"), pa.array(rules, pa.string()), pa.array(verdicts, pa.string())], names=[*names, "host", "path", "rule", "verdict"])

    return run


def judge(pages: DataFrame, rules: DataFrame, *, url: str = "url", default: str = "allow") -> DataFrame:
    """All columns of pages (but old ones of the new names), with host, path, rule and verdict.

    A rule (verdict, host, path) fits a URL of its host or a subdomain whose
    path starts with the rule's.  The longest rule (host and path as one
    string; of equal ones the one of the deeper host) wins; of two verdicts for
    one rule `block` does.  Without a rule, rule is null and verdict `default`.
    A null URL, or one without `://`, has empty host and path.  Rules with a
    null in them or an empty host are left out.  Equal rows are judged one by one.
    """
    spark = pages.sparkSession
    new = ["host", "path", "rule", "verdict"]
    names = [c for c in pages.columns if c not in new]
    u = F.col(f"`{url}`")
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), host_of(u).alias("_host"), path_of(u).alias("_path"), F.xxhash64(*[f"`{c}`" for c in names if not dict(pages.dtypes)[c].startswith("map")]).alias("_salt"))
    rows = rows.withColumns({"_turned": turned(F.col("_host")), "_kind": F.lit(1), "_rule": F.lit(None).cast("string"), "_verdict": F.lit(None).cast("string")})
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    count = rows.count()
    sample = rows.select("_turned", "_path", "_salt")
    if count > ranges * SAMPLE:
        sample = sample.sample(ranges * SAMPLE / count, seed=17)
    seen = sorted(tuple(r) for r in sample.collect())
    borders = sorted({seen[k * len(seen) // ranges] for k in range(1, ranges)}) if seen else []

    host = F.translate("host", UPPER, LOWER)
    given = rules.dropna(subset=["host", "path", "verdict"]).where("host <> ''").select(turned(host).alias("_turned"), F.col("path").alias("_path"), F.concat(host, "path").alias("_rule"), F.col("verdict").alias("_verdict"))

    def deal(batches):
        for batch in batches:
            keys = zip(batch.column("_turned").to_pylist(), batch.column("_path").to_pylist(), batch.column("_salt").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([bisect_right(borders, k) for k in keys], pa.int32()), *batch.columns], names=["_part", *batch.schema.names])

    def spread(batches):
        for batch in batches:
            part, row = [], []
            for k, turn in enumerate(batch.column("_turned").to_pylist()):
                after = turn[:-1] + "0" if turn else None  # the first turned host past the interval
                lo = bisect_right(borders, (turn, "", -(2**63)))
                hi = bisect_right(borders, (after, "", -(2**63))) if turn else len(borders)
                part += range(lo, hi + 1)
                row += [k] * (hi + 1 - lo)
            taken = batch.take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), *taken.columns], names=["_part", *taken.schema.names])

    schema = lambda df: "_part int, " + ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
    dealt = rows.mapInArrow(deal, schema(rows))
    spread_out = given.mapInArrow(spread, schema(given)).withColumn("_kind", F.lit(0))
    both = dealt.unionByName(spread_out, allowMissingColumns=True)
    swept = both.repartitionById(ranges, "_part").sortWithinPartitions("_part", "_turned", "_kind")
    judged = swept.mapInArrow(_sweep(default, ["_row"]), f"_row {dict(rows.dtypes)['_row']}, host string, path string, rule string, verdict string")
    return judged.select("_row.*", *new)


def op2_url_filter(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, rules_frame(spark)).drop("url")


OP2_SQL = r"""
with u as (
  select page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
  from pages),
r(verdict, rhost, rpath) as (values ('allow','org','/'), ('block','example.org','/es/'), ('block','example.org','/en/1'), ('allow','com','/fr/'), ('block','com','/de/')),
m as (
  select u.page_id, r.rhost || r.rpath as rule, r.verdict,
    row_number() over (partition by u.page_id order by length(r.rhost || r.rpath) desc) as k
  from u join r on (u.host = r.rhost or ends_with(u.host, '.' || r.rhost)) and starts_with(u.path, r.rpath))
select u.page_id, u.host, u.path, m.rule, coalesce(m.verdict, 'allow') as verdict
from u left join m on u.page_id = m.page_id and m.k = 1
"""
