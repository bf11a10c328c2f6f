"""Personal data by weak supervision.

Patterns propose spans.  Three labelers vote on each: its pattern's own check
(`shape`), a gazetteer (top-level domains, card issuer digits, country codes,
key prefixes) and the words around it (`context`).  Expectation maximisation
over the counts of vote patterns estimates how reliable each labeler is for
each kind, and gives every vote pattern a probability.  With these as soft
labels a naive Bayes span classifier is trained on what a span looks like; it
decides the spans that no base rule settles.  What the driver handles are
counts, whose number the features bound.  DataFrame operations only: spans are
found by splitting and extracting with one pattern, so a position is a sum of
lengths.  Arrays of n spans are walked in about sqrt(n) pieces of sqrt(n), as
each step of a fold copies what it appends to: n * sqrt(n) steps, not n * n.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.arrays import let, pieces, walk
from loomgraph.storage import settle

KINDS = ["email", "ip", "card", "phone", "secret"]
BASE = KINDS[:4]

# A search that has just ended may start again inside a run (\G); elsewhere a
# match starts where its run does, so nothing is scanned twice.  Possessive
# repeats change no match here and need no stack.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "local": r"(?<![0-9+(.-])\(?[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{24,}+",
}
# Something that any match has, cheap to look for.
HINTS = {"email": lambda t: F.contains(t, F.lit("@")), "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"), "card": lambda t: t.rlike(r"[0-9][ -]?[0-9]"), "phone": lambda t: F.contains(t, F.lit("+")), "local": lambda t: t.rlike(r"[0-9][ .-][0-9]{4}"), "secret": lambda t: t.rlike(r"[A-Za-z0-9_-]{24}")}

# What the gazetteer knows.
DOMAINS = "com org net edu gov io dev info biz eu de fr es it uk us ca au jp cn in br nl ch se no fi dk pl pt be at"
CARD_STARTS = "^[ -]?(?:4|5[1-5]|2[2-7]|3[47]|36|38|6011|65|35)"
COUNTRY_CODES = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
KEY_STARTS = "^(?:sk-|sk_|pk_|ghp_|gho_|github_pat_|AKIA|ASIA|AIza|xox[abp]-|glpat-|eyJ)"
CUES = {
    "email": "mail|contact|write|address|adres",
    "ip": "ip|host|server|address|adres|login|log",
    "card": "card|carte|karte|tarjeta|visa|master|credit|payment|cc",
    "phone": "phone|tel|call|mobile|fax|anruf|appel|ll[aá]m",
    "secret": "token|secret|key|passw|pwd|auth|bearer|api|cred",
}

_ONE = "struct<kind:string,start:int,end:int,hit:string,before:string,after:string,source:string>"
_SPAN = f"array<{_ONE}>"


def matches(text: Column, pattern: str, kind: str, source: str) -> Column:
    """The leftmost non-overlapping matches with positions in code points and what stands around them."""
    found = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))
    zipped = lambda p: F.arrays_zip(F.slice(p["gaps"], F.lit(1), F.size(p["hits"])).alias("gap"), p["hits"].alias("hit"), F.slice(p["gaps"], F.lit(2), F.size(p["hits"])).alias("next"))

    def step(at, x):
        end = at + F.length(x["gap"]) + F.length(x["hit"])
        return end, F.array(end)

    def span(x):
        return F.struct(F.lit(kind).alias("kind"), (x["end"] - F.length(x["hit"])).alias("start"), x["end"].alias("end"), x["hit"].alias("hit"), F.right(x["gap"], F.lit(24)).alias("before"), F.left(x["next"], F.lit(1)).alias("after"), F.lit(source).alias("source"))

    def placed(rows):
        return F.transform(F.arrays_zip(rows.alias("row"), walk(rows, F.lit(0), "int", step).alias("end")), lambda x: span({"gap": x["row"]["gap"], "hit": x["row"]["hit"], "next": x["row"]["next"], "end": x["end"]}))

    return F.when(HINTS[source](text), let(let(found, zipped), placed)).otherwise(F.array().cast(_SPAN))


def meets(s: Column, groups: Column) -> Column:
    """Whether a span overlaps one of those that `grouped` cut into pieces."""
    overlap = lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])
    return F.exists(groups, lambda g: overlap(g) & F.exists(g["spans"], overlap))


def grouped(spans: Column) -> Column:
    """Spans by place in pieces, each with the least start and the greatest end of its spans."""
    slim = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    return F.transform(pieces(slim), lambda g: F.struct(F.array_min(F.transform(g, lambda s: s["start"])).alias("start"), F.array_max(F.transform(g, lambda s: s["end"])).alias("end"), g.alias("spans")))


def _luhn(digits: Column) -> Column:
    digit = lambda i: F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
    part = lambda i: F.when(i % 2 == 1, digit(i)).when(digit(i) > 4, digit(i) * 2 - 9).otherwise(digit(i) * 2)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda acc, i: acc + part(i)) % 10 == 0


def passes(s: Column) -> Column:
    """Whether a match of a base pattern is one of its kind."""
    digits = F.regexp_replace(s["hit"], "[^0-9]", "")
    return (
        F.when(s["source"] == "email", F.lit(True))
        .when(s["source"] == "ip", s["hit"].rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.|$)){4}$"))
        .when(s["source"] == "card", F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(F.lit(False)))
        .when(s["source"] == "phone", F.length(digits).between(9, 15))
        .otherwise(F.lit(False))
    )


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with `_base`, the spans of the base rules by kind and start, and `_other`, all that must be judged.

    These replace columns of their names; all others stay, whatever their names.
    """
    # the rows go through as one struct, so that no column of theirs can clash
    found = docs.select(F.struct("*").alias("_row"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("_text"))
    found = found.select("_row", *[matches(F.col("_text"), PATTERNS[p], "phone" if p == "local" else p, p).alias(p) for p in PATTERNS])
    # a shorter run of digits is no card by any reading
    close = lambda s: ~passes(s) & ((s["source"] != "card") | F.length(F.regexp_replace(s["hit"], "[^0-9]", "")).between(12, 20))
    found = found.select("_row", F.concat(*[F.filter(k, passes) for k in BASE]).alias("base"), F.concat(*[F.filter(k, close) for k in BASE], "local", "secret").alias("other"))
    other = F.when(F.size("other") == 0, F.col("other")).otherwise(let(grouped(F.col("base")), lambda groups: F.filter("other", lambda s: ~meets(s, groups))))
    found = found.select("_row", F.col("base").alias("_base"), other.alias("_other"))
    return found.select(*[F.col(f"_row.`{c}`") for c in docs.columns if c not in ("_base", "_other")], "_base", "_other")


def votes(s: Column) -> list[Column]:
    """1, 0 or -1 from the labelers shape, gazetteer and context."""
    hit, before = s["hit"], F.lower(s["before"])
    shape = F.when(s["source"] == "secret", F.when(hit.rlike("^[0-9a-f]{32,}$|^[A-Za-z0-9_-]{32,}$"), 1).otherwise(0)).when(s["source"] == "local", 0).when(passes(s), 1).otherwise(-1)
    domain = F.lower(F.element_at(F.split(hit, r"\."), -1))
    gazetteer = (
        F.when(s["kind"] == "email", F.when(domain.isin(DOMAINS.split()), 1).otherwise(-1))
        .when(s["kind"] == "ip", F.when(hit.rlike(r"^0|^255\.|\.0\.0\.0$"), -1).otherwise(0))
        .when(s["kind"] == "card", F.when(hit.rlike(CARD_STARTS), 1).otherwise(-1))
        .when(s["kind"] == "phone", F.when(hit.rlike(COUNTRY_CODES), 1).when(hit.rlike(r"^\(?555"), -1).otherwise(0))
        .otherwise(F.when(hit.rlike(KEY_STARTS), 1).otherwise(0))
    )
    cue = F.lit(False)
    for kind, pattern in CUES.items():
        cue = F.when(s["kind"] == kind, before.rlike(rf"(?:{pattern})[a-z]*[\s:='\"(#]*(?:[a-z]{{1,3}}[\s:='\"]+)?$")).otherwise(cue)
    glued = s["before"].rlike(r"[A-Za-z0-9_./@-]$") | s["after"].rlike(r"[A-Za-z0-9_/@]")
    context = F.when(cue, 1).when(glued, -1).otherwise(0)
    return [v.cast("int") for v in (shape, gazetteer, context)]


def looks(s: Column) -> list[Column]:
    """What the span classifier sees, as small labels."""
    hit = s["hit"]
    share = F.floor(F.length(F.regexp_replace(hit, "[^0-9]", "")) * 4 / F.length(hit))
    around = lambda c: F.when(c == "", "end").when(c.rlike(r"\s"), "space").when(c.rlike("[A-Za-z0-9]"), "word").otherwise("mark")
    return [F.concat(F.lit("source="), s["source"]), F.concat(F.lit("length="), F.least(F.floor(F.length(hit) / 4), F.lit(12)).cast("string")), F.concat(F.lit("digits="), share.cast("string")), F.concat(F.lit("left="), around(F.right(s["before"], F.lit(1)))), F.concat(F.lit("right="), around(s["after"]))]


def expectation_maximisation(counts: dict[tuple, int], rounds: int = 60) -> dict[tuple, float]:
    """The probability of being personal data for each vote pattern, from {(votes): count} of one kind."""
    share, rate = 0.5, {}
    believed = {v: 1 / (1 + math.exp(-1.5 * sum(v))) for v in counts}
    for _ in range(rounds):
        # pseudo-counts say that a labeler is right rather than wrong
        rate = {(j, x, y): 1.0 + 2.0 * (x == (1 if y else -1)) for j in range(3) for x in (-1, 0, 1) for y in (0, 1)}
        for v, n in counts.items():
            for j, x in enumerate(v):
                rate[j, x, 1] += n * believed[v]
                rate[j, x, 0] += n * (1 - believed[v])
        for j in range(3):
            for y in (0, 1):
                total = sum(rate[j, x, y] for x in (-1, 0, 1))
                for x in (-1, 0, 1):
                    rate[j, x, y] /= total
        share = (1 + sum(n * believed[v] for v, n in counts.items())) / (2 + sum(counts.values()))
        for v in counts:
            odds = math.log(share / (1 - share)) + sum(math.log(rate[j, x, 1] / rate[j, x, 0]) for j, x in enumerate(v))
            believed[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return believed


def train(found: DataFrame) -> dict[str, float]:
    """{'kind|look': log odds} of the span classifier, from the frame that `candidates` gives.

    The rows collected are counts by kind, votes and looks, a bounded number.
    """
    spans = found.select(F.explode(F.concat("_base", "_other")).alias("s")).select(F.col("s.kind").alias("kind"), *[v.alias(f"v{j}") for j, v in enumerate(votes(F.col("s")))], F.array(*looks(F.col("s"))).alias("looks"))
    rows = spans.groupBy("kind", "v0", "v1", "v2", "looks").count().collect()
    counts: dict[str, dict[tuple, int]] = defaultdict(lambda: defaultdict(int))
    for r in rows:
        counts[r["kind"]][r["v0"], r["v1"], r["v2"]] += r["count"]
    believed = {kind: expectation_maximisation(c) for kind, c in counts.items()}
    seen: dict[tuple, list[float]] = defaultdict(lambda: [1.0, 1.0])
    for r in rows:
        p = believed[r["kind"]][r["v0"], r["v1"], r["v2"]]
        for look in ["", *r["looks"]]:
            pair = seen[r["kind"], look]
            pair[0] += r["count"] * (1 - p)
            pair[1] += r["count"] * p
    weights = {}
    for (kind, look), (no, yes) in seen.items():
        all_no, all_yes = seen[kind, ""]
        weights[f"{kind}|{look}"] = math.log(yes / no) if look == "" else math.log(yes / all_yes) - math.log(no / all_no)
    return weights


def spans(found: DataFrame, weights: dict[str, float]) -> DataFrame:
    """found with `spans`: the base spans, and other ones that the classifier accepts, but those that overlap one accepted before them, by start."""
    # a table of a bounded number of weights, as a literal
    table = F.create_map(*[F.lit(x) for kv in sorted(weights.items()) for x in kv]) if weights else F.create_map(F.lit(""), F.lit(0.0))
    weight = lambda key: F.coalesce(F.try_element_at(table, key), F.lit(0.0))

    def accepted(s):
        score = weight(F.concat(s["kind"], F.lit("|")))
        for look in looks(s):
            score = score + weight(F.concat(s["kind"], F.lit("|"), look))
        return score > 0

    slim = "struct<order:int,start:int,end:int,kind:string>"

    def step(end, s):
        free = s["start"] >= end
        return F.when(free, s["end"]).otherwise(end), F.when(free, F.array(F.struct(s["order"].alias("order"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))).otherwise(F.array().cast(f"array<{slim}>"))

    # by place, and at one place in the order of kinds
    place = F.create_map(*[x for k, kind in enumerate(KINDS) for x in (F.lit(kind), F.lit(k))])
    by_place = F.array_sort(F.transform(F.filter("_other", accepted), lambda s: F.struct(s["start"].alias("start"), place[s["kind"]].alias("order"), s["end"].alias("end"), s["kind"].alias("kind"))))
    added = F.when(F.size("_other") == 0, F.array().cast(f"array<{slim}>")).otherwise(walk(by_place, F.lit(0), slim, step))
    base = F.transform("_base", lambda s: F.struct(place[s["kind"]].alias("order"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return found.withColumn("spans", F.array_sort(F.concat(base, added)))


def joined(array: Column) -> Column:
    return F.array_join(F.transform(array, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def detect(docs: DataFrame, *, text: str = "text", weights: dict[str, float] | None = None) -> DataFrame:
    """docs with `_base` and `spans` (order, start, end, kind; end exclusive, in code points), which replace columns of these names.

    The classifier is trained on all of docs unless weights are given.  Null
    text is empty.  Rows are judged one by one, so repeated ones get equal spans.
    No other column is touched, whatever its name.
    """
    found = candidates(docs, text)
    if weights is None:
        weights = train(found)
    return spans(found, weights).drop("_other")


def redact(docs: DataFrame, *, text: str = "text", weights: dict[str, float] | None = None) -> DataFrame:
    """docs with each span replaced by its kind in brackets, as in `[EMAIL]`; a null text stays null.

    Where spans of two kinds overlap, what they cover together becomes the
    kind of the one that starts first.  `n_chars`, if there is one, is the new
    length.
    """
    # the rows go through as one struct, so that no column of theirs can clash
    found = detect(docs.select(F.struct("*").alias("_row"), F.col(f"`{text}`").alias("_text")), text="_text", weights=weights)
    t = F.col("_text")
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    # what is copied before each stretch of spans, and the kind that replaces the stretch
    record = "struct<from:int,to:int,kind:string>"

    def step(at, s):
        new = F.array(F.struct(at.alias("from"), s["start"].alias("to"), s["kind"].alias("kind")))
        return F.greatest(at, s["end"]), F.when(s["start"] >= at, new).otherwise(F.array().cast(f"array<{record}>"))

    def rewritten(piece):
        # the piece's part of the text is cut out once, as finding a code point is a walk from the start
        first, last = F.get(piece, F.lit(0))["from"], F.get(piece, F.size(piece) - 1)["to"]
        return let(F.substring(t, first + 1, last - first), lambda part: F.array_join(F.transform(piece, lambda r: F.concat(F.substring(part, r["from"] - first + 1, r["to"] - r["from"]), F.lit("["), F.upper(r["kind"]), F.lit("]"))), ""))

    end = F.array_max(F.transform("spans", lambda s: s["end"]))
    clean = F.concat(F.array_join(F.transform(pieces(walk(ordered, F.lit(0), record, step)), rewritten), ""), F.substring(t, end + 1, F.length(t)))
    new = {text: F.when(t.isNull() | (F.size("spans") == 0), t).otherwise(clean)}
    if "n_chars" in docs.columns and text != "n_chars":
        new["n_chars"] = F.coalesce(F.length(new[text]).cast(dict(docs.dtypes)["n_chars"]), F.col("_row.n_chars"))
    return found.select(*[new[c].alias(c) if c in new else F.col(f"_row.`{c}`") for c in docs.columns])


def op4_pii(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = settle(candidates(docs).drop("text"))
    out = spans(found, train(found))
    count = lambda kind: F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", *[count(k) for k in BASE], F.sha2(joined(F.col("_base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))
