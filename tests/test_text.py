import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomgraph.functions import rules, text
from loomgraph.operators import chunking


def value(spark, column, **fields):
    types = {k: "int" if isinstance(v, int) else "string" for k, v in fields.items()}
    return spark.createDataFrame([tuple(fields.values())], ", ".join(f"{k} {t}" for k, t in types.items())).select(column.alias("v")).first()["v"]


def fold(body, chunk_size=800, heading_size=200):
    """The chunking rules, line by line."""
    out, buffer, size = [], [], 0
    for line in body.split("\n"):
        head, blank = line.strip().startswith("#"), not line.strip()
        if head and buffer and size > heading_size:
            out.append("\n".join(buffer))
            buffer, size = [line], len(line) + 1
            continue
        size += len(line) + 1
        if size > chunk_size and blank:
            out.append("\n".join(buffer))
            buffer, size = [], 0
        else:
            buffer.append(line)
    return out + (["\n".join(buffer)] if buffer else [])


SPLITS = ["", "\n", "a", "a\n\n", "x" * 199 + "\n# h", "x" * 200 + "\n# h", "x" * 799 + "\n\nb", "x" * 798 + "\n\nb", "x" * 900 + "\r\n\r\ny\r\n# z", " \n\t\n", "# a\n## b\n" + "y" * 201 + "\n ## c\n", "x" * 900 + "\n　\nend"]


@pytest.mark.parametrize("body", SPLITS)
def test_split_by_structure(spark, body):
    assert value(spark, text.split_by_structure(F.col("t")), t=body) == fold(body)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["# h", "", " ", "word " * 30, "## x", "y" * 250]), max_size=14).map("\n".join), min_size=1, max_size=8))
def test_split_by_structure_holds_for_any_lines(spark, bodies):
    rows = spark.createDataFrame([(k, b) for k, b in enumerate(bodies)], "k int, t string").select("k", text.split_by_structure(F.col("t")).alias("c")).collect()
    assert {r["k"]: r["c"] for r in rows} == {k: fold(b) for k, b in enumerate(bodies)}


def test_headings_keep_a_stack(spark):
    body = "# A\nx\n## B\n# C\n ## indented\n#### D\ntext # no"
    got = [(r["offset"], r["level"], r["path"]) for r in value(spark, text.headings(F.col("t")), t=body)]
    assert got == [(0, 1, "A"), (6, 2, "A > B"), (11, 1, "C"), (15, 0, "## indented"), (28, 4, "## indented > D")]


def test_heading_lookup_in_raw_and_in_collapsed_positions(spark):
    """Runs of spaces before a heading make the collapsed position fall before it."""
    body = "# First\n" + "a" + " " * 600 + "b\n# Second\n" + "chunk " * 200
    docs = spark.createDataFrame([(1, body)], "id int, t string")
    path = lambda compat: [r["header_path"] for r in chunking.chunk_documents(docs, text="t", header_paths=True, compat=compat).orderBy("chunk_id").collect()]
    assert path(False) == ["First", "Second"]
    assert path(True) == ["First", "First"]


def test_default_title(spark):
    assert value(spark, text.default_title(F.col("t")), t="x\n## Some title \ny") == "Some title"
    assert value(spark, text.default_title(F.col("t")), t="\n" * 20 + "# late") == "Unknown"


def test_blank_chunks_leave_gaps(spark):
    docs = spark.createDataFrame([("f", "x" * 900 + "\n\n" + " " * 900 + "\n\nend"), ("g", "")], "filename string, text string")
    rows = chunking.chunk_documents(docs).orderBy("chunk_id").collect()
    assert [(r["filename"], r["chunk_id"]) for r in rows] == [("f", 0), ("f", 2)]
    assert all(r["chunk"].strip() for r in rows)


ROLES = [
    ("Summary", "", "Abstract"), ("Data Analysis", "", "Methods_Materials"), ("1. x", "", "Introduction"), ("2. y", "", "Methods_Materials"), ("3. x", "", "Results"), ("3.1 x", "", "Other"),
    ("3.1.2 x", "", "Discussion"), ("4. x", "", "Conclusion"), ("10. x", "", "Other"), ("研究背景", "", "Introduction"), ("实验方法", "", "Methods_Materials"), ("参考文献", "", "References"),
    ("Outlook", "", "Conclusion"), ("", "We collected ten", "Methods_Materials"), ("", "It showed that", "Results"), ("", "x" * 200 + " showed", "Other"), ("x > Health", "", "Discussion"), (None, None, "Other"),
]


def test_section_roles(spark):
    rows = spark.createDataFrame([(k, h, t) for k, (h, t, _) in enumerate(ROLES)], "k int, header_path string, text string")
    got = {r["k"]: r["section_role"] for r in chunking.infer_roles(rows).collect()}
    assert got == {k: want for k, (_, _, want) in enumerate(ROLES)}


def test_roles_that_no_rule_gives_are_asked_for(spark):
    rows = spark.createDataFrame([(1, "zzz", "q"), (2, "Results", "q"), (3, "yyy", "q")], "k int, header_path string, text string")
    answers = {"zzz": "I think it is the CONCLUSION.", "yyy": "no idea"}
    got = {r["k"]: r["section_role"] for r in chunking.infer_roles(rows, lambda h, t: answers[h]).collect()}
    assert got == {1: "Conclusion", 2: "Results", 3: "Other"}


@pytest.mark.parametrize("name, want", [(None, "Other"), ("  ", "Other"), ("Methods", "Methods_Materials"), (" bibliography\t", "References"), ("Experiment", "Experiment"), ("unknown ", "unknown")])
def test_canonical_section(spark, name, want):
    assert spark.createDataFrame([(name,)], "n string").select(rules.canonical_section(F.col("n")).alias("v")).first()["v"] == want


def test_prior_roles_fall_back_to_other(spark):
    priors = spark.createDataFrame([("Results", ["EBM", "XXX", "MPU"]), ("Other", [])], "section_role string, roles array<string>")
    rows = chunking.view_roles(spark.createDataFrame([("results",), ("strange",), (None,)], "section_role string"), priors).collect()
    assert {(r["section_role"], tuple(r["view_roles"])) for r in rows} == {("Results", ("EBM", "MPU")), ("strange", ()), ("Other", ())}


SENTENCES = [
    ("One. Alpha met BETA here. Alpha and beta", "alpha", "Beta", "Alpha met BETA here"), ("甲和乙。丙", "甲", "乙", "甲和乙"), ("First. Second x", "", "x", "Second x"), ("no names here. " + "z" * 300, "q", "r", None),
    (".. a b", "", "", None), ("A" + "b" * 400 + " c", "a", "c", "A" + "b" * 299), (None, "a", "b", "..."),
]


def test_evidence_sentences(spark):
    rows = spark.createDataFrame([(k, t, a, b) for k, (t, a, b, _) in enumerate(SENTENCES)], "k int, t string, a string, b string").select("k", rules.evidence_sentence(F.col("t"), F.col("a"), F.col("b")).alias("v")).collect()
    for r in rows:
        body, _, _, want = SENTENCES[r["k"]]
        assert r["v"] == (want if want is not None else body[:200].strip() + "...")


def test_relation_weights_by_tier(spark):
    cases = [("It CAUSED harm", None, 0.85), ("p<0.05", None, 0.85), ("was linked to", None, 0.7), ("the mayor said", None, 0.4), ("plain", None, 0.5), ("significant", 0.0, 0.0), (None, None, 0.5), ("关联 and 可能", None, 0.7)]
    rows = spark.createDataFrame([(k, s, w) for k, (s, w, _) in enumerate(cases)], "k int, s string, w double").select("k", rules.relation_weight(F.col("w"), F.col("s")).alias("v")).collect()
    assert {r["k"]: r["v"] for r in rows} == {k: c[2] for k, c in enumerate(cases)}


def test_node_weights(spark):
    cases = [("mp_Claim", "n", "t", None, 0.85), ("mp_Claim", "n", "the main claim", None, 0.95), ("whu_Specimen", "n", None, None, 0.75), ("mp_Method", "n", None, None, 0.6), ("x", "keyed", None, None, 0.6), ("mp_Claim", None, "main", None, None), ("x", "n", "main", 0.0, 0.0)]
    rows = spark.createDataFrame([(k, *c[:4]) for k, c in enumerate(cases)], "k int, l string, n string, t string, w double").select("k", rules.node_weight(F.col("w"), F.col("l"), F.col("n"), F.col("t")).alias("v")).collect()
    assert {r["k"]: r["v"] and round(r["v"], 9) for r in rows} == {k: c[4] for k, c in enumerate(cases)}


def test_strip_and_collapse_know_all_blanks(spark):
    assert value(spark, text.strip(F.col("t")), t="　\t a b \r\n") == "a b"
    assert value(spark, text.collapse(F.col("t")), t="a　\n b") == "a b"


def test_semantic_groups_with_windows(spark):
    vectors = [[1.0, 0.0], [1.0, 0.1], [0.0, 1.0], [0.1, 1.0], [1.0, 1.0]]
    rows = spark.createDataFrame([("d", k, v) for k, v in enumerate(vectors)], "doc string, k int, embedding array<float>")
    group = lambda w: [r["group"] for r in chunking.semantic_groups(rows, by=["doc"], order=["k"], threshold=0.76, window=w).orderBy("k").collect()]
    assert group(1) == [0, 0, 1, 1, 1]
    assert group(2) == [0, 0, 1, 1, 2]
    sentences = spark.createDataFrame([("A b. C d! 好。 E",)], "t string").select(chunking.split_sentences(F.col("t")).alias("s")).first()["s"]
    assert sentences == ["A b.", "C d!", "好。", "E"]


def test_join_text_orders_and_drops_blanks(spark):
    rows = spark.createDataFrame([("f", 2, " b "), ("f", 1, "a"), ("f", 3, " "), ("f", 4, None), ("g", 1, "")], "f string, i int, text string")
    assert [tuple(r) for r in chunking.join_text(rows, by=["f"], order=["i"]).collect()] == [("f", "a\n\nb")]


def test_cosine_edge_cases(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0], [0.0, 2.0]), (2, [0.0], [1.0]), (3, [1.0], [1.0, 2.0]), (4, None, [1.0]), (5, [3.0], [0.5])], "k int, a array<double>, b array<double>")
    assert [r["v"] for r in rows.select("k", text.cosine(F.col("a"), F.col("b")).alias("v")).orderBy("k").collect()] == [0.0, None, None, None, 1.0]
