"""Operators that judge or rewrite single rows."""

import hashlib
import random
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from loomgraph.llm import bpe, chat, pii, quality, url_rules

SMALL = "/root/testdata/sf0.001"


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# --- URLs ------------------------------------------------------------------


def judged(url, rules, default="allow"):
    url = url or ""
    _, mark, rest = url.partition("://")
    host = re.match(r"[^/?#]*", rest)[0] if mark else ""
    path = re.match(r"[^?#]*", rest[len(host) :])[0] if mark else ""
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), len(h), h + p, v) for v, h, p in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, key=lambda x: (x[0], x[1], x[3] == "block"), default=None)
    return host, path, best and best[2], best[3] if best else default


def test_op2_equals_sql(spark, same):
    same(spark, url_rules.op2_url_filter, url_rules.OP2_SQL, SMALL)


@pytest.mark.parametrize("ranges", ["1", "4", "23"])
def test_url_rules_equal_brute_force(spark, ranges):
    rng = random.Random(int(ranges))
    label = lambda: rng.choice(["a", "b", "org", "example", "x-y", ""])
    host = lambda n: ".".join(label() for _ in range(n))
    path = lambda: rng.choice(["", "/", "/es/", "/es/1", "/en/1", "/en/12/x", "/é"])
    rules = [(rng.choice(["allow", "block"]), host(rng.randint(1, 3)), path()) for _ in range(60)] + url_rules.RULES
    urls = [f"{rng.choice(['http://', 'HTTPS://', '', 'x://y://'])}{host(rng.randint(0, 5)).upper()}{path()}{rng.choice(['', '?q=/es/', '#f', '/z'])}" for _ in range(600)]
    urls += [None, "", "://", "no url", "http://a.ORG:80/es/", "http://u@org/x", "a\nb://org/\n/fr/", "http://org", "http://org?x"] + ["http://www.example.org/es/"] * 50
    rows = spark.createDataFrame([(k, u, "r", 1) for k, u in enumerate(urls)], "page_id long, url string, rule string, _turned int")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        out = url_rules.judge(rows, url_rules.rules_frame(spark, rules))
        assert out.columns == ["page_id", "url", "_turned", "host", "path", "rule", "verdict"]
        got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == {k: judged(u, rules) for k, u in enumerate(urls)}


def test_url_rules_of_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    rules = url_rules.rules_frame(spark)
    assert url_rules.judge(pages.where("false"), rules).count() == 0
    assert url_rules.judge(pages, rules.where("false"), default="block").first()["verdict"] == "block"


# --- personal data -----------------------------------------------------------


def base_spans(text):
    text, out = text or "", []
    found = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    for kind, pattern in found.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255:
                continue
            if kind == "card":
                doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
                if not 13 <= len(digits) <= 19 or sum(d - 9 * (d > 9) for d in doubled) % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(3)
    rows = ["".join(rng.choice("ab1.9@-+ (5)0%_é😀\n") for _ in range(rng.randint(0, 80))) for _ in range(1500)]
    rows += ["".join(rng.choice("0123456789 -") for _ in range(rng.randint(0, 60))) for _ in range(800)]
    rows += [None, "", "4111 1111 1111 1111", "1.2.3.4.5.6.7.8", "x@y.com_z@q.org a@b.c@d.e", "255.256.1.1 000.1.2.3", "1" * 30_000, "a." * 20_000 + "@", "+1 " + "()" * 500, "4" * 16 + " " + "0" * 13]
    rows = list(enumerate(rows))
    found = pii.candidates(frame(spark, rows)).select("doc_id", "_base").collect()
    assert {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["_base"]] for r in found} == {d: base_spans(t) for d, t in rows}


def test_op4_digests(spark):
    rows = {r["doc_id"]: r for r in pii.op4_pii(spark, SMALL).collect()}
    t = pq.read_table(f"{SMALL}/documents.parquet").to_pydict()
    for d, text in zip(t["doc_id"], t["text"]):
        want = base_spans(text)
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert [rows[d][f"n_{k}"] for k in pii.BASE] == [sum(x[0] == k for x in want) for k in pii.BASE]
        assert rows[d]["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        all_spans = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in rows[d]["spans"].split(",") if s)]
        assert set(want) <= set(all_spans) and all_spans == sorted(all_spans, key=lambda s: (pii.KINDS.index(s[0]), s[1]))


def test_votes_add_what_the_base_rules_miss(spark):
    secret = "0123456789abcdef0123456789abcdef01234567"
    texts = [f'the token = "{secret}" here', "call me: 555-123-4567 soon", "tel. (212) 555-0188", "nothing at all", "mail bob@example.com"] * 30
    rows = frame(spark, list(enumerate(texts)))
    got = {r["text"]: {s["kind"] for s in r["spans"]} for r in pii.detect(rows).collect()}
    assert got[texts[0]] == {"secret"} and got[texts[3]] == set() and got[texts[4]] == {"email"}


def test_em_finds_the_reliable_labeler():
    counts = {(1, 1, 0): 80, (1, -1, 0): 20, (-1, -1, 0): 90, (-1, 1, 0): 10}
    believed = pii.expectation_maximisation(counts)
    assert believed[1, 1, 0] > 0.9 > 0.1 > believed[-1, -1, 0]


def test_redaction(spark):
    schema = "doc_id long, text string, n_chars int, spans string, _base int, _text string"
    rows = spark.createDataFrame([(1, "é a@b.org, 10.0.0.1, 4111111111111111 +1 (743) 555-3824!", 0, "s", 1, "u"), (2, None, 5, "s", 1, "u"), (3, "", 9, "s", 1, "u"), (4, "clean", 5, "s", 1, "u"), (4, "clean", 5, "s", 1, "u")], schema)
    out = pii.redact(rows)
    assert out.columns == rows.columns
    got = sorted((r["doc_id"], r["text"], r["n_chars"], r["spans"]) for r in out.collect() if r["text"] is not None)
    assert got == [(1, "é [EMAIL], [IP], [CARD] [PHONE]!", 32, "s"), (3, "", 0, "s"), (4, "clean", 5, "s"), (4, "clean", 5, "s")]
    assert pii.redact(rows.where("false")).count() == 0
    assert not any(re.search("Python|Arrow|Pandas", line) for line in out._jdf.queryExecution().executedPlan().toString().splitlines())


# --- BPE -------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.vocabulary_path())
    t.no_truncation()
    t.no_padding()
    return t


def odd_texts():
    rng = random.Random(1)
    pool = "abcdefghijklmnopqrstuvwxyz ABC  \n\t'sré日本語😀0123456789.,!?<|endoftext|>\x1c\x85  ²Ⅷ"
    return ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(1500)] + ["", " ", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "x" * 5000, "ab" * 3000, "internationalization unhappily " * 50, None]


def test_bpe_equals_the_library(spark, library):
    texts = odd_texts()
    rows = spark.createDataFrame([(k, t, "old") for k, t in enumerate(texts)], "doc_id long, text string, ids string")
    out = bpe.encode(rows, digests=True)
    got = {r["doc_id"]: r for r in out.collect()}
    for k, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[k]["ids"] == ids and got[k]["n_tokens"] == len(ids) and got[k]["text"] == text
        assert got[k]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[k]["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode(rows.where("false")).count() == 0


def test_op7_equals_the_library(spark, library):
    t = pq.read_table(f"{SMALL}/documents.parquet").to_pydict()
    got = {r["doc_id"]: r["ids_sha256"] for r in bpe.op7_bpe_roundtrip(spark, SMALL).collect()}
    assert got == {d: hashlib.sha256(",".join(map(str, library.encode(x, add_special_tokens=False).ids)).encode()).hexdigest() for d, x in zip(t["doc_id"], t["text"])}


def test_bpe_forgets_and_goes_on(monkeypatch, library):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    with open(bpe.vocabulary_path(), "rb") as f:
        merges = bpe.Merges(f.read())
    texts = [t or "" for t in odd_texts()]
    for k in range(0, len(texts), 40):
        assert merges.encode(texts[k : k + 40]) == [",".join(map(str, e.ids)) for e in library.encode_batch(texts[k : k + 40], add_special_tokens=False)]


def test_pair_checks_equal_exact_merging():
    import numpy as np

    with open(bpe.vocabulary_path(), "rb") as f:
        merges = bpe.Merges(f.read())
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 50256, 4000), rng.integers(0, 2000, 4000)
    want = [merges.exact(merges.bytes[a] + merges.bytes[b]) == [a, b] for a, b in zip(x.tolist(), y.tolist())]
    assert merges.compatible(x, y).tolist() == want
    assert merges._exact_long(b"internationalization" * 5) == merges.exact(b"internationalization" * 5)


# --- chat ------------------------------------------------------------------


def test_op10_equals_sql(spark, same):
    same(spark, chat.op10_chat_rotation, chat.OP10_SQL, SMALL)


def test_masks_cover_the_participants_turns(spark):
    rows = [(1, 2, "bob", "hi <|end|> é"), (1, 1, "amy", "😀 yo"), (1, 0, "system", "be kind"), (1, None, None, None), (1, 3, " ", "?"), (1, 3, "amy", "same"), (1, 3, "amy", "same"), (2, 0, "system", "alone"), (None, 1, "x", "y"), (3, 255, "a", "p"), (3, 256, "a", "q")]
    talk = spark.createDataFrame([(*r, 0, "z") for r in rows], "conv_id long, turn int, role string, text string, part int, mask string")
    out = chat.rotate(talk).collect()
    by = {(r["conv_id"], r["part"], r["participant"]): r for r in out}
    assert set(by) == {(1, p, who) for p in (0, None) for who in ("amy", "bob", "unknown")} | {(None, 0, "x"), (3, 0, "a"), (3, 1, "a")}
    r = by[1, 0, "amy"]
    assert r["rendered"].startswith("<|system|>\nbe kind<|end|>\n<|assistant|>\n😀 yo<|end|>\n<|user bob|>\nhi < |end|> é<|end|>\n")
    assert r["start"] == len(by[1, None, "amy"]["rendered"]) > 0 and by[3, 1, "a"]["start"] == len(by[3, 0, "a"]["rendered"])
    cut = [r["rendered"][int(a) - r["start"] : int(b) - r["start"]] for a, b in (s.split(":") for s in r["mask"].split(","))]
    assert cut == ["😀 yo<|end|>", "same<|end|>", "same<|end|>"] and r["n_target"] == 3 and r["n_turns"] == 6
    assert by[1, 0, "unknown"]["n_target"] == 1 and by[1, None, "bob"]["mask"] == ""
    assert chat.rotate(talk.where("false")).count() == 0


def test_a_long_dialogue_is_one_dialogue_in_pieces(spark):
    rows = [(7, k, ("system", "ann", "ben", "cy")[k % 4 if k else 0], f"turn {k} " + "é" * (k % 3)) for k in range(1000)]
    talk = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    pieces = {(r["participant"], r["start"]): r for r in chat.rotate(talk).collect()}
    assert len(pieces) == 12
    for r in chat.whole(chat.rotate(talk)).collect():
        who = r["participant"]
        assert r["n_turns"] == 1000 and r["n_target"] == 250 and r["rendered"].count("<|system|>") == 250
        assert r["rendered"] == "".join(p["rendered"] for _, p in sorted(((s, p) for (w, s), p in pieces.items() if w == who)))
        cut = [r["rendered"][int(a) : int(b)] for a, b in (s.split(":") for s in r["mask"].split(","))]
        assert cut == [f"{t}<|end|>" for _, _, w, t in rows if w == who]
        # rendering it as one piece gives the same
        one = chat.rotate(talk, part_turns=10**6).where(F.col("participant") == who).first()
        assert (one["rendered"], one["mask"], one["start"]) == (r["rendered"], r["mask"], 0)


# --- quality ---------------------------------------------------------------


def corpus(n=3000, seed=2):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeioustrnl") for _ in range(rng.randint(2, 8))) for _ in range(2500)]
    docs, bad = [], []
    for _ in range(n):
        own = [rng.choice(words) for _ in range(rng.randint(5, 200))]
        kind = rng.random()
        if kind < 0.1:
            own = [w.upper() + "!!" for w in own]
        elif kind < 0.2:
            own[rng.randrange(len(own))] = rng.choice(["slur", "Slur,", "SLUR"])
        bad.append(kind < 0.2)
        docs.append(" ".join(own))
    return docs, bad


def test_held_out_accuracy(spark):
    docs, bad = corpus()
    rows = spark.createDataFrame([(k, t, "w", 1.0) for k, t in enumerate(docs)], "doc_id long, text string, weight string, _key double")
    labels = spark.createDataFrame([(k, int(not b), 0) for k, b in enumerate(bad) if k % 2], "doc_id long, quality int, toxic int")
    kept = quality.keep_good(rows, labels)
    assert kept.columns == rows.columns
    ids = {r["doc_id"] for r in kept.collect()}
    good = [k for k, b in enumerate(bad) if not b and k % 2 == 0]
    ugly = [k for k, b in enumerate(bad) if b and k % 2 == 0]
    assert sum(k in ids for k in good) >= 0.97 * len(good) and sum(k in ids for k in ugly) <= 0.05 * len(ugly)
    model = quality.fit(rows, labels)
    few = quality.resample(rows, labels, keep=100)
    assert few[1].where(F.col("key") >= few[2]).count() == 100 and (model.ratios < 0).any()


def test_quality_of_odd_rows(spark):
    schema = "doc_id long, quality int, toxic int"
    rows = spark.createDataFrame([(1, None), (2, ""), (None, "x y"), (3, "long " * 50_000), (3, "long " * 50_000)], "doc_id long, text string")
    for labels in ([], [(1, None, None), (None, 1, 0), (99, 0, 1)], [(1, 1, 0), (1, 1, 0)], [(2, 0, 0)]):
        assert quality.keep_good(rows, spark.createDataFrame(labels, schema)).count() == 5
    none = rows.where("false")
    assert quality.keep_good(none, spark.createDataFrame([(1, 1, 0)], schema)).count() == 0


def test_kth_largest(spark):
    rng = random.Random(5)
    values = [rng.choice([rng.random(), 0.5]) for _ in range(3000)]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 10, 1500, 3000):
        assert quality.kth_largest(rows, "x", k, exact=50) == sorted(values, reverse=True)[k - 1]
    assert quality.kth_largest(rows, "x", 0) == float("inf")
