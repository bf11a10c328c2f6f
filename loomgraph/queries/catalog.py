"""One query for each operator of the graph engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph import checks
from loomgraph.functions import rules
from loomgraph.graph import centrality as central
from loomgraph.graph.components import connected_components
from loomgraph.ontology import SECTION_ALIASES, Ontology, default_ontology, problems
from loomgraph.operators import chunking, dedup, extraction, metadata, resolve, retrieval, views
from loomgraph.plans import paths
from loomgraph.queries.views import Tables, with_views
from loomgraph.sources.markdown import select_documents, with_metadata
from loomgraph.storage import settle
from loomgraph.streaming import events

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of Tables by its name, with its SQL."""

    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


# --- sources ---------------------------------------------------------------


@query("select doc_id::varchar as filename, n_chars from documents order by doc_id::varchar limit 25")
def doc_select_max(t: Tables) -> DataFrame:
    docs = t.documents.select(F.col("doc_id").cast("string").alias("filename"), "n_chars")
    return select_documents(docs, max_docs=25)


@query("""
select d.doc_id || '.md' as filename,
  case when l.toxic = 1 then 'labelled ' || d.doc_id else d.doc_id::varchar end as dc_title,
  case when l.toxic = 1 then 'q' || l.quality else 'Unknown' end as dc_author,
  case when l.toxic = 1 then null else 'local:' || d.doc_id || '.md' end as dcterms_identifier,
  case when l.toxic = 1 then null else 'Research Article' end as dc_type
from documents d left join labels l on d.doc_id = l.doc_id
""")
def doc_metadata_default(t: Tables) -> DataFrame:
    """Labels play the sidecars; those of documents that are not toxic lack a publisher, so defaults apply."""
    none = F.lit(None).cast("string")
    fields = {c: none for c in ("dc_creator", "dc_type", "dc_language", "dc_subject", "dcterms_issued", "dcterms_identifier", "source", "source_filename", "processed_at")}
    side = t.labels.select(F.col("doc_id").cast("string").alias("base"), F.concat(F.lit("labelled "), F.col("doc_id").cast("string")).alias("dc_title"), F.concat(F.lit("q"), F.col("quality").cast("string")).alias("dc_author"), F.when(F.col("toxic") == 1, "press").alias("dc_publisher"), *[v.alias(k) for k, v in fields.items()])
    docs = t.documents.select(F.concat(F.col("doc_id").cast("string"), F.lit(".md")).alias("filename"))
    return with_metadata(docs, side).select("filename", "dc_title", "dc_author", "dcterms_identifier", "dc_type")


# --- chunking --------------------------------------------------------------

_FOLD = """
fold as (
  select doc_id, 0 as i, []::varchar[] as chunks, []::varchar[] as buf, 0 as size from v_md
  union all
  select f.doc_id, f.i + 1,
    case when l.cut_before and len(f.buf) > 0 and f.size > 200 then list_append(f.chunks, array_to_string(f.buf, chr(10)))
         when f.size + length(l.line) + 1 > 800 and l.blank then list_append(f.chunks, array_to_string(f.buf, chr(10))) else f.chunks end,
    case when l.cut_before and len(f.buf) > 0 and f.size > 200 then [l.line]
         when f.size + length(l.line) + 1 > 800 and l.blank then []::varchar[] else list_append(f.buf, l.line) end,
    case when l.cut_before and len(f.buf) > 0 and f.size > 200 then length(l.line) + 1
         when f.size + length(l.line) + 1 > 800 and l.blank then 0 else f.size + length(l.line) + 1 end
  from fold f join (select *, starts_with(trim(line, ' ' || chr(9) || chr(13)), '#') as cut_before, trim(line, ' ' || chr(9) || chr(13)) = '' as blank from v_lines) l on l.doc_id = f.doc_id and l.i = f.i + 1),
done as (select doc_id, case when len(buf) > 0 then list_append(chunks, array_to_string(buf, chr(10))) else chunks end as chunks
  from fold f where i = (select max(i) from v_lines l where l.doc_id = f.doc_id)),
pieces as (select doc_id, k - 1 as chunk_id, chunks[k] as chunk from (select doc_id, chunks, unnest(range(1, len(chunks) + 1)) as k from done)),
v_chunks as (select * from pieces where trim(chunk, ' ' || chr(9) || chr(10) || chr(13)) <> '')
"""


@query(with_views("v_md v_lines", "select doc_id, chunk_id, chunk from v_chunks", _FOLD, recursive=True))
def chunk_split(t: Tables) -> DataFrame:
    return chunking.chunk_documents(t.markdown().select("doc_id", "md"), text="md")


_HEADS = """
raw as (select doc_id, i, line, (sum(length(line) + 1) over (partition by doc_id order by i rows unbounded preceding) - length(line) - 1)::int as off from v_lines),
hl as (select doc_id, off, line, row_number() over (partition by doc_id order by i) as k, length(line) - length(ltrim(line, '#')) as level, trim(ltrim(line, '#'), ' ' || chr(9) || chr(13)) as title
  from raw where starts_with(trim(line, ' ' || chr(9) || chr(13)), '#')),
walk as (
  select doc_id, k, off, level, title, [{'level': level, 'title': title}] as stack from hl where k = 1
  union all
  select h.doc_id, h.k, h.off, h.level, h.title, list_append(list_filter(w.stack, lambda s: s.level < h.level), {'level': h.level, 'title': h.title})
  from walk w join hl h on h.doc_id = w.doc_id and h.k = w.k + 1),
v_heads as (select doc_id, off as "offset", level::int as level, title, array_to_string(list_transform(stack, lambda s: s.title), ' > ') as path from walk)
"""


@query(with_views("v_md v_lines", 'select doc_id, "offset", level, title, path from v_heads', _HEADS, recursive=True))
def header_paths(t: Tables) -> DataFrame:
    return chunking.document_headings(t.markdown().select("doc_id", "md"), text="md")


@query(with_views("v_md v_lines", """
select c.doc_id, c.chunk_id, coalesce(
  (select arg_max(h.path, h."offset") from v_heads h where h.doc_id = c.doc_id and h."offset" <= strpos(m.md, left(c.chunk, 50)) - 1),
  (select arg_min(h.title, h."offset") from v_heads h where h.doc_id = c.doc_id), 'Unknown') as header_path
from v_chunks c join v_md m on c.doc_id = m.doc_id
""", _FOLD.strip() + ",\n" + _HEADS.strip(), recursive=True))
def header_path_asof(t: Tables) -> DataFrame:
    return chunking.chunk_documents(t.markdown().select("doc_id", "md"), text="md", header_paths=True).drop("chunk")


@query(with_views("v_md v_lines", """
select c.doc_id, c.chunk_id, coalesce(
  (select arg_max(h.path, h."offset") from v_heads h where h.doc_id = c.doc_id and h."offset" <= m.at),
  (select arg_min(h.title, h."offset") from v_heads h where h.doc_id = c.doc_id), 'Unknown') as header_path
from v_chunks c join (select c.doc_id, c.chunk_id, strpos(regexp_replace(m.md, '\\s+', ' ', 'g'), regexp_replace(trim(left(c.chunk, 50), ' ' || chr(9) || chr(10) || chr(13)), '\\s+', ' ', 'g')) - 1 as at from v_chunks c join v_md m on c.doc_id = m.doc_id) m
  on m.doc_id = c.doc_id and m.chunk_id = c.chunk_id
""", _FOLD.strip() + ",\n" + _HEADS.strip(), recursive=True))
def header_path_collapsed(t: Tables) -> DataFrame:
    """Headings looked up by positions in the text with white space collapsed."""
    return chunking.chunk_documents(t.markdown().select("doc_id", "md"), text="md", header_paths=True, compat=True).drop("chunk")


_ESC = lambda words: "|".join(rules.re.escape(w).replace("\\ ", " ") for w in words).replace("'", "''")


def _role_sql(header: str, body: str) -> str:
    """The rules as CASE; RE2 has no lookahead, so `3.` not before a digit is spelt out."""
    h, b = f"lower({header})", f"lower(left({body}, 200))"
    out = ""
    for role, words, pattern in rules.SECTION_RULES:
        pattern = {r"^3\.(?!\d)": r"^3\.([^0-9]|$)", r"^3\.\d+\.": r"^3\.[0-9]+\."}.get(pattern, pattern)
        out += f" when regexp_matches({h}, '{_ESC(words)}')" + (f" or regexp_matches({h}, '{pattern}')" if pattern else "") + f" then '{role}'"
    for role, words in rules.TEXT_RULES:
        out += f" when regexp_matches({b}, '{_ESC(words)}') then '{role}'"
    return f"case{out} else 'Other' end"


# Headings with words that the rules know, by the kind of document; the tables' own headings have none.
_HEAD_SQL = "case doc_id % 9 when 0 then '1. ' when 1 then '2. ' when 2 then '3. ' when 3 then '3.1. ' when 4 then '4. ' when 5 then 'References ' when 6 then 'Data ' when 7 then 'Summary ' else '' end || source"


def _headed(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.expr(_HEAD_SQL).alias("header_path"), "text")


@query(f"select doc_id, {_role_sql('header_path', 'text')} as section_role from (select doc_id, {_HEAD_SQL} as header_path, text from documents)")
def section_role(t: Tables) -> DataFrame:
    return chunking.infer_roles(_headed(t)).select("doc_id", "section_role")


@query(with_views("v_priors", f"select r.doc_id, r.section_role, p.roles as view_roles from (select doc_id, {_role_sql('header_path', 'text')} as section_role from (select doc_id, {_HEAD_SQL} as header_path, text from documents)) r join v_priors p on p.section_role = r.section_role"))
def role_prior(t: Tables) -> DataFrame:
    rows = chunking.view_roles(chunking.infer_roles(_headed(t)), t.priors())
    return rows.select("doc_id", "section_role", F.array_join("view_roles", ",").alias("view_roles"))


def _alias_sql(name: str) -> str:
    """Aliases and blank names as CASE."""
    bare = f"trim({name}, ' ' || chr(9) || chr(10) || chr(13))"
    known = "".join(f" when lower({bare}) = '{k}' then '{v}'" for k, v in SECTION_ALIASES.items())
    return f"case when coalesce({bare}, '') = '' then 'Other'{known} else {bare} end"


# names in the ways that files spell them, by conversation turn
_SPELT_SQL = "case turn % 8 when 0 then ' Methods ' when 1 then 'BIBLIOGRAPHY' when 2 then null when 3 then '  ' when 4 then 'abstract' when 5 then 'Results' when 6 then role || ' part' else upper(role) end"


@query(f"select conv_id, turn, role, {_alias_sql('said')} as section from (select conv_id, turn, role, {_SPELT_SQL} as said from conversations)")
def canonical_sections(t: Tables) -> DataFrame:
    return t.conversations.select("conv_id", "turn", "role", rules.canonical_section(F.expr(_SPELT_SQL)).alias("section"))


# free answers of a model about a role
_ANSWER_SQL = "case doc_id % 6 when 0 then 'Results' when 1 then 'It is the DISCUSSION, I think' when 2 then 'methods_materials or results' when 3 then source when 4 then null else 'see ' || lang || ' references' end"


def _answer_role_sql(answer: str) -> str:
    exact = ", ".join(f"'{r}'" for r in rules.ROLES)
    return f"case when {answer} in ({exact}) then {answer}" + "".join(f" when contains(lower({answer}), '{r.lower()}') then '{r}'" for r in rules.ROLES) + " else 'Other' end"


@query(f"select doc_id, {_answer_role_sql('answer')} as section_role from (select doc_id, {_ANSWER_SQL} as answer from documents)")
def answered_roles(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", rules.role_from_answer(F.expr(_ANSWER_SQL)).alias("section_role"))


@query("""
select vec_id, label, similarity, is_break, (sum(is_break) over (partition by label order by vec_id))::bigint as "group" from (
  select vec_id, label, round(s, 6) as similarity, case when s < 0.1 then 1 else 0 end as is_break from (
    select vec_id, label, list_cosine_similarity(embedding::double[], (lag(embedding) over (partition by label order by vec_id))::double[]) as s from embeddings))
""")
def semantic_breaks(t: Tables) -> DataFrame:
    rows = chunking.semantic_groups(t.embeddings, by=["label"], order=["vec_id"], threshold=0.1)
    return rows.select("vec_id", "label", F.round("similarity", 6).alias("similarity"), "is_break", "group")


@query("select conv_id, string_agg(text, chr(10) || chr(10) order by turn, text) as joined from (select conv_id, turn, trim(text, ' ' || chr(9) || chr(10) || chr(13)) as text from conversations) where text <> '' group by conv_id")
def join_text(t: Tables) -> DataFrame:
    return chunking.join_text(t.conversations, by=["conv_id"], order=["turn"])


# --- extraction ------------------------------------------------------------


@query("""
with tpl(template_id, sections) as (values (1, ['user']), (2, ['assistant', 'system']), (3, ['All']), (4, ['References'])),
picked as (select c.conv_id, t.template_id, c.turn, trim(c.text, ' ' || chr(9) || chr(10) || chr(13)) as text from conversations c join tpl t on list_contains(t.sections, c.role) or list_contains(t.sections, 'All'))
select conv_id, template_id, string_agg(text, chr(10) || chr(10) order by turn, text) as joined from picked where text <> '' group by conv_id, template_id
""")
def section_routing(t: Tables) -> DataFrame:
    """Speakers play the sections."""
    templates = t.spark.createDataFrame([(1, ["user"]), (2, ["assistant", "system"]), (3, ["All"]), (4, ["References"])], "template_id int, sections array<string>")
    chunks = t.conversations.select("conv_id", F.col("turn").alias("index"), F.col("role").alias("section_role"), "text")
    return extraction.route(chunks, templates, doc="conv_id")


_EVENT_JSON = """concat('{"nodes": [{"id": "u", "label": "user", "properties": {"k": "', get_json_object(props, '$.k'), '"}}, {"id": "e", "label": "', event_type, '", "properties": {}}], "relationships": [{"type": "did", "start_node_id": "u", "end_node_id": "e", "properties": {"v": "', cast(cast(value as int) as string), '"}}]}')"""


@query("""
select event_id || '|1|u' as src, event_id || '|1|e' as dst, 'did' as rel_type, json_extract_string(props, '$.k') as k
from events where event_type = 'purchase'
""")
def contract_parse(t: Tables) -> DataFrame:
    """Events as an extractor's JSON; the template admits users and purchases."""
    templates = t.spark.createDataFrame([(1, "user", "did", "purchase")], "template_id int, subject string, relation string, object string")
    outputs = t.events.select("event_id", F.lit(1).alias("template_id"), F.expr(_EVENT_JSON).alias("output"))
    nodes, edges = extraction.conforming(*extraction.parse_outputs(outputs, doc="event_id"), templates)
    who = nodes.select(F.col("entity_id").alias("src"), F.try_element_at("props", F.lit("k")).alias("k"))
    return edges.join(who, "src").select("src", "dst", "rel_type", "k")


@query(with_views("v_nodes v_edges", """
select n.id, count(e.src) as n from v_nodes n left join v_edges e on e.src = n.id and e.rel_type = 'contains' where n.label = 'order' group by n.id having count(e.src) not between 2 and 5
"""))
def gate_violations(t: Tables) -> DataFrame:
    """Orders of fewer than 2 or more than 5 parts."""
    return checks.wrong_cardinality(t.nodes(), t.edges(), "order", "contains", least=2, most=5)


@query(with_views("v_nodes v_edges", "select e.src, e.rel_type, e.dst, e.rel_id from v_edges e join v_nodes s on s.id = e.src join v_nodes d on d.id = e.dst where e.rel_type = 'located_in' and s.label = 'customer' and d.label = 'nation'"))
def gate_forbidden(t: Tables) -> DataFrame:
    """Customers that are located in a nation, as if that were not allowed."""
    return checks.forbidden_edges(t.nodes(), t.edges(), "located_in", "customer", "nation").select("src", "rel_type", "dst", "rel_id")


@query("select o_orderkey, o_orderstatus from orders where o_orderstatus is not null and o_orderstatus not in ('F', 'O')")
def gate_values(t: Tables) -> DataFrame:
    return checks.values_outside(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["F", "O"])


_WORDS = [("W1", "article", "the"), ("W2", "place", "in"), ("W3", "article", "der"), ("W4", "place", "les"), ("W5", "verb", "was")]


@query("""
with dict(entity_id, label, word) as (values ('W1', 'article', 'the'), ('W2', 'place', 'in'), ('W3', 'article', 'der'), ('W4', 'place', 'les'), ('W5', 'verb', 'was')),
m as (select distinct d.doc_id, x.entity_id, x.label from (select doc_id, unnest(regexp_extract_all(lower(text), '([\\p{L}\\p{N}_]+)')) as word from documents) d join dict x on x.word = d.word)
select a.doc_id, a.entity_id as src, r.rel_type, b.entity_id as dst
from m a join (values ('article', 'before', 'place'), ('verb', 'after', 'article')) r(s, rel_type, o) on a.label = r.s join m b on b.doc_id = a.doc_id and b.label = r.o and a.entity_id <> b.entity_id
""")
def rule_extract(t: Tables) -> DataFrame:
    words = t.spark.createDataFrame(_WORDS, "entity_id string, label string, name string")
    templates = t.spark.createDataFrame([("article", "before", "place"), ("verb", "after", "article")], "subject string, relation string, object string")
    return extraction.rule_extract(t.documents.select("doc_id", "text"), words, templates, chunk="doc_id")[1]


# --- metadata --------------------------------------------------------------


@query("""
with nodes as (select item_id as ordinal, left(trim(text, ' ' || chr(9) || chr(10) || chr(13)), 50) as preview from benchmark),
hit as (select d.doc_id, max(n.ordinal) as ordinal, count(*) as n from documents d join nodes n on contains(d.text, n.preview) where n.preview <> '' group by d.doc_id)
select d.doc_id as chunk_id, case when h.ordinal is null then null else 'bench' end as filename, 'path ' || h.ordinal as header_path from documents d left join hit h on h.doc_id = d.doc_id
""")
def chunk_backfill(t: Tables) -> DataFrame:
    """Benchmark items play the nodes, documents without a file the stored chunks."""
    none = F.lit(None).cast("string")
    stored = t.documents.select(F.col("doc_id").alias("chunk_id"), none.alias("filename"), "text", none.alias("header_path"), none.alias("section_role"), none.alias("from_section"), F.lit(None).cast("array<string>").alias("view_roles"))
    nodes = t.benchmark.select(F.col("item_id").alias("ordinal"), F.lit("bench").alias("filename"), "text", F.concat(F.lit("path "), F.col("item_id").cast("string")).alias("header_path"), none.alias("section_role"), F.array().cast("array<string>").alias("view_roles"))
    return metadata.backfill_chunks(stored, nodes)[0].select("chunk_id", "filename", "header_path")


def _chunk_rows(t: Tables) -> DataFrame:
    """Orders as chunks: the status is the section; urgent ones have metadata already."""
    none = F.lit(None).cast("string")
    return t.orders.select(F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("chunk_id"), F.concat(F.lit("C"), F.col("o_custkey").cast("string"), F.lit(".md")).alias("filename"), F.col("o_orderkey").cast("int").alias("index"), F.when(F.col("o_orderpriority") == "1-URGENT", "kept").alias("dc_title"), none.alias("dc_author"), none.alias("dc_publisher"), none.alias("dc_type"), none.alias("dc_language"), none.alias("dcterms_identifier"), F.col("o_orderstatus").alias("section_role"), none.alias("from_section"), none.alias("source_doc"))


def _chunk_docs(t: Tables) -> DataFrame:
    none = F.lit(None).cast("string")
    return t.customer.select(F.concat(F.lit("C"), F.col("c_custkey").cast("string"), F.lit(".md")).alias("filename"), F.col("c_name").alias("dc_title"), F.col("c_mktsegment").alias("dc_author"), *[none.alias(c) for c in ("dc_publisher", "dc_type", "dc_language", "dcterms_identifier")])


_META = """
m as (select 'O' || o.o_orderkey as chunk_id, o.o_orderkey as idx, case when o.o_orderpriority = '1-URGENT' then 'kept' else c.c_name end as dc_title,
  case when o.o_orderpriority = '1-URGENT' then null else c.c_mktsegment end as dc_author,
  case when o.o_orderpriority = '1-URGENT' then null else 'local:C' || o.o_custkey end as dcterms_identifier,
  case when o.o_orderpriority = '1-URGENT' then null else o.o_orderstatus end as from_section
  from orders o join customer c on c.c_custkey = o.o_custkey)
"""


@query("with " + _META + "select chunk_id, dc_title, dc_author, dcterms_identifier, from_section from m")
def meta_chunk(t: Tables) -> DataFrame:
    return metadata.chunk_metadata(_chunk_rows(t), _chunk_docs(t)).select("chunk_id", "dc_title", "dc_author", "dcterms_identifier", "from_section")


@query(with_views("v_nodes v_from_chunk", """
select n.id as entity_id, b.r.dc_title as dc_title, b.r.from_section as from_section from v_nodes n
left join (select f.entity_id, arg_min({'dc_title': m.dc_title, 'from_section': m.from_section}, m.idx) as r from v_from_chunk f join m on m.chunk_id = f.chunk_id group by f.entity_id) b on b.entity_id = n.id
""", _META))
def meta_entity(t: Tables) -> DataFrame:
    none = F.lit(None).cast("string")
    entities = t.nodes().select(F.col("id").alias("entity_id"), none.alias("dc_title"), none.alias("from_section"))
    chunks = metadata.chunk_metadata(_chunk_rows(t), _chunk_docs(t))
    return metadata.entity_metadata(entities, t.from_chunk(), chunks)


@query(with_views("v_edges v_from_chunk", """
select e.rel_id, case when a.idx is null or b.idx < a.idx then b.r else a.r end.dc_title as dc_title, case when a.idx is null or b.idx < a.idx then b.r else a.r end.from_section as from_section
from v_edges e left join first a on a.entity_id = e.src left join first b on b.entity_id = e.dst
""", _META.strip() + """,
first as (select f.entity_id, min(m.idx) as idx, arg_min({'dc_title': m.dc_title, 'from_section': m.from_section}, m.idx) as r from v_from_chunk f join m on m.chunk_id = f.chunk_id group by f.entity_id)
"""))
def meta_relation(t: Tables) -> DataFrame:
    none = F.lit(None).cast("string")
    relations = t.edges().select("rel_id", "src", "dst", none.alias("dc_title"), none.alias("from_section"))
    chunks = metadata.chunk_metadata(_chunk_rows(t), _chunk_docs(t))
    return metadata.relation_metadata(relations, t.from_chunk(), chunks).select("rel_id", "dc_title", "from_section")


@query("""
with w as (select doc_id, text, regexp_extract(text, '^([^ .]+)', 1) as a, regexp_extract(text, '([^ .]+)[ .]*$', 1) as b from documents),
s as (select doc_id, text, list_filter(string_split(replace(text, '。', '.'), '.'), lambda x: contains(lower(x), lower(a)) and contains(lower(x), lower(b)))[1] as hit from w)
select doc_id, coalesce(nullif(left(trim(hit, ' ' || chr(9) || chr(10) || chr(13)), 300), ''), trim(left(text, 200), ' ' || chr(9) || chr(10) || chr(13)) || '...') as sentence from s
""")
def evidence_sentence(t: Tables) -> DataFrame:
    """The first and last words of a document play the names."""
    first, last = F.regexp_extract("text", r"^([^ .]+)", 1), F.regexp_extract("text", r"([^ .]+)[ .]*$", 1)
    return t.documents.select("doc_id", rules.evidence_sentence(F.col("text"), first, last).alias("sentence"))


@query(with_views("v_edges", "select rel_id, case when rel_type = 'placed' then 'order' else lower(replace(rel_type, '_', ' ')) end as name from v_edges"))
def relation_name(t: Tables) -> DataFrame:
    given = F.when(F.col("rel_type") == "placed", "order").when(F.col("rel_type") == "contains", "")
    return t.edges().select("rel_id", rules.relation_name(given, F.col("rel_type")).alias("name"))


def _weight_sql(sentence: str) -> str:
    """The keyword rules as CASE."""
    return "case" + "".join(f" when regexp_matches({sentence}, '{_ESC(words)}') then {w}" for w, words in rules.WEIGHT_RULES) + f" else {rules.DEFAULT_WEIGHT} end"


_ENDS = r"regexp_extract(text, '^([^ .]+)', 1) as a, regexp_extract(text, '([^ .]+)[ .]*$', 1) as b"


@query(f"""
with w as (select doc_id, {_ENDS} from documents),
p as (select w.*, least(w.doc_id, coalesce(e.doc_id, w.doc_id)) as chunk from w left join documents e on e.doc_id = w.doc_id - w.doc_id % 2),
s as (select p.*, d.text, list_filter(string_split(replace(d.text, '。', '.'), '.'), lambda x: contains(lower(x), lower(a)) and contains(lower(x), lower(b)))[1] as hit from p join documents d on d.doc_id = p.chunk),
t as (select doc_id, coalesce(nullif(left(trim(hit, ' ' || chr(9) || chr(10) || chr(13)), 300), ''), trim(left(text, 200), ' ' || chr(9) || chr(10) || chr(13)) || '...') as said from s)
select 'R' || doc_id as rel_id, case when doc_id % 5 = 0 then 'given' else said end as original_text, case when doc_id % 5 = 0 then '' else 'begins with' end as name,
  case when doc_id % 7 = 0 then 0.9 when doc_id % 5 = 0 then null else {_weight_sql('lower(said)')} end as llm_weight
from t
""")
def meta_writeback(t: Tables) -> DataFrame:
    """Each document relates its first word to its last, which the document before may mention too."""
    words = t.documents.select("doc_id", F.regexp_extract("text", r"^([^ .]+)", 1).alias("a"), F.regexp_extract("text", r"([^ .]+)[ .]*$", 1).alias("b"))
    key = lambda p: F.concat(F.lit(p), F.col("doc_id").cast("string"))
    entities = words.select(key("A").alias("entity_id"), F.col("a").alias("name")).unionByName(words.select(key("B").alias("entity_id"), F.col("b").alias("name")))
    held = words.select(key("A").alias("entity_id"), F.col("doc_id").alias("chunk_id")).unionByName(words.select(key("B").alias("entity_id"), (F.col("doc_id") - F.col("doc_id") % 2).alias("chunk_id")))
    due = F.col("doc_id") % 5 != 0
    relations = t.documents.select(key("R").alias("rel_id"), key("A").alias("src"), key("B").alias("dst"), F.lit("BEGINS_WITH").alias("rel_type"), F.lit("").alias("name"), F.when(~due, "given").alias("original_text"), F.when(F.col("doc_id") % 7 == 0, F.lit(0.9)).alias("llm_weight"), F.lit(None).cast("string").alias("dcterms_identifier"))
    chunks = t.documents.select(F.col("doc_id").alias("chunk_id"), F.col("doc_id").cast("int").alias("index"), "text")
    return metadata.enhance_relations(relations, entities, held, chunks).select("rel_id", "original_text", "name", "llm_weight")


_SAID_SQL = "case o_orderkey % 6 when 0 then 'It MAY cause harm' when 1 then 'was linked to' when 2 then 'the mayor said' when 3 then 'nothing' when 4 then '可能 later' else null end"


@query(f"""
select o_orderkey, coalesce(w, case when s like '%significant%' or s like '%cause%' then 0.85 when s like '%linked%' then 0.7 when s like '%may%' or s like '%可能%' then 0.4 else 0.5 end) as weight
from (select o_orderkey, lower({_SAID_SQL}) as s, case when o_orderstatus = 'P' then 0.0 end as w from orders)
""")
def relation_weight(t: Tables) -> DataFrame:
    given = F.when(F.col("o_orderstatus") == "P", F.lit(0.0))
    return t.orders.select("o_orderkey", rules.relation_weight(given, F.expr(_SAID_SQL)).alias("weight"))


@query("""
select p_partkey, round(least(case p_partkey % 4 when 0 then 0.85 when 1 then 0.75 when 2 then 0.6 else 0.5 end + case when p_size > 40 then 0.1 else 0.0 end, 1.0), 6) as weight from part
""")
def node_weight(t: Tables) -> DataFrame:
    label = F.expr("case p_partkey % 4 when 0 then 'mp_Claim' when 1 then 'whu_Specimen' when 2 then 'mp_Method' else 'other' end")
    said = F.when(F.col("p_size") > 40, F.lit("a critical part"))
    return t.part.select("p_partkey", F.round(rules.node_weight(F.lit(None).cast("double"), label, F.lit("xyz"), said), 6).alias("weight"))


@query(with_views("v_edges", "select rel_id, rel_type from v_edges where rel_type = 'placed' order by rel_id limit 100"))
def topk_unenhanced(t: Tables) -> DataFrame:
    """The operator's optional top-k, by rel_id; `placed` relations have no evidence."""
    relations = t.edges().withColumn("original_text", F.when(F.col("rel_type") != "placed", "given"))
    return metadata.unenhanced(relations, 100).select("rel_id", "rel_type")


# --- chunk dedup -----------------------------------------------------------

_DUP = "select lang as filename, text, min(doc_id) as survivor, count(*) as copies from documents group by lang, text"


@query(f"select filename, survivor, copies from ({_DUP}) where copies > 1")
def chunk_dup_groups(t: Tables) -> DataFrame:
    return dedup.duplicate_groups(t.chunks()).drop("text_key")


@query(f"select d.doc_id as chunk_id, g.survivor from documents d join ({_DUP}) g on g.filename = d.lang and g.text = d.text")
def chunk_dedup_survivors(t: Tables) -> DataFrame:
    return dedup.survivors(t.chunks())


@query(f"""
with s as (select d.doc_id as node, d.lang, g.survivor, g.copies from documents d join ({_DUP}) g on g.filename = d.lang and g.text = d.text),
e as (select doc_id as src, lead(doc_id) over (partition by lang order by doc_id) as dst from documents),
r as (select a.survivor as src, b.survivor as dst, (a.node <> a.survivor or b.node <> b.survivor) as touched from e join s a on a.node = e.src join s b on b.node = e.dst)
select distinct src, dst from r where not (touched and src = dst)
""")
def edge_repoint(t: Tables) -> DataFrame:
    chunks = t.chunks()
    chain = dedup.next_chunks(chunks).select("src", "dst", F.lit("NEXT_CHUNK").alias("rel_type"), F.create_map().cast("map<string,string>").alias("props"))
    mapping = dedup.survivors(chunks).select(F.col("chunk_id").alias("node"), "survivor", F.col("chunk_id").alias("place"))
    return dedup.repoint_edges(chain, mapping).select("src", "dst")


@query(f"""
with s as (select d.doc_id as node, d.lang, g.survivor from documents d join ({_DUP}) g on g.filename = d.lang and g.text = d.text),
e as (select doc_id as src, lead(doc_id) over (partition by lang order by doc_id) as dst from documents),
r as (select e.src as old_src, a.survivor as src, b.survivor as dst, a.node <> a.survivor as src_moved, b.node <> b.survivor as dst_moved, a.node as place_a, b.node as place_b, e.dst as old_dst from e join s a on a.node = e.src join s b on b.node = e.dst),
k as (select src, dst, old_src, old_dst, (src_moved or dst_moved) as touched_now, greatest(case when src_moved then place_a else -1 end, case when dst_moved then place_b else -1 end) as place,
  src in (select survivor from s where node <> survivor) or dst in (select survivor from s where node <> survivor) as touched from r),
kept as (select * from k where not (touched and src = dst))
select src, dst, arg_max('from ' || old_src, {{'touched': touched, 'place': place, 'src': old_src, 'dst': old_dst}}) as via from kept group by src, dst
""")
def edge_props(t: Tables) -> DataFrame:
    """Of edges that agree after the merge, the last one's property wins."""
    chunks = t.chunks()
    chain = dedup.next_chunks(chunks).select("src", "dst", F.lit("NEXT_CHUNK").alias("rel_type"), F.create_map(F.lit("via"), F.concat(F.lit("from "), F.col("src").cast("string"))).alias("props"))
    mapping = dedup.survivors(chunks).select(F.col("chunk_id").alias("node"), "survivor", F.col("chunk_id").alias("place"))
    return dedup.repoint_edges(chain, mapping).select("src", "dst", F.try_element_at("props", F.lit("via")).alias("via"))


@query("select lang as filename, doc_id as src, dst from (select lang, doc_id, lead(doc_id) over (partition by lang order by doc_id) as dst from documents) where dst is not null")
def chunk_chain(t: Tables) -> DataFrame:
    return dedup.next_chunks(t.chunks())


@query(f"""
select (select count(*) from documents) as original_chunks, count(*) filter (where copies > 1) as duplicate_groups, coalesce(sum(copies - 1) filter (where copies > 1), 0)::bigint as merged_chunks,
  count(*) as final_chunks, round(((select count(*) from documents) - count(*)) * 100.0 / (select count(*) from documents), 2)::double as compression_percent, 0::bigint as duplicate_groups_remaining, true as chain_complete, true as success from ({_DUP})
""")
def dedup_verify(t: Tables) -> DataFrame:
    chunks = t.chunks()
    kept = settle(dedup.drop_duplicates(chunks))
    return dedup.merge_report(chunks, kept, dedup.next_chunks(kept))


@query(f"""
select (select count(*) from documents) as chunk_count, (select count(*) from documents) - count(distinct lang) - 1 as next_chunk_relations, (select count(*) from documents) as indexed_chunks,
  (select count(*) from ({_DUP}) where copies > 1) as duplicate_groups_remaining, false as chain_complete from documents
""")
def dedup_unmerged(t: Tables) -> DataFrame:
    """The checks on chunks that were not merged, whose chain lacks a link."""
    chain = dedup.next_chunks(t.chunks())
    return dedup.verify_merge(t.chunks(), chain.where(F.col("src") != chain.agg(F.min("src")).first()[0]))


# --- views -----------------------------------------------------------------


@query(with_views("v_views", "select label, string_agg(view, ',' order by view_order) as subgraphs from v_views group by label"))
def view_labels(t: Tables) -> DataFrame:
    return views.label_views(t.views()).select("label", F.array_join("subgraphs", ",").alias("subgraphs"))


_ASSIGNED = "va as (select n.id, n.label, x.subgraphs, case when x.k = 1 then x.subgraphs end as subgraph from v_nodes n left join (select label, string_agg(view, ',' order by view_order) as subgraphs, count(*) as k from v_views group by label) x on x.label = n.label)"


def _assigned(t: Tables) -> DataFrame:
    return views.assign_views(t.nodes().select(F.col("id").alias("entity_id"), "label"), t.views())


@query(with_views("v_nodes v_views", "select id as entity_id, subgraphs, subgraph from va", _ASSIGNED))
def view_assign(t: Tables) -> DataFrame:
    return _assigned(t).select("entity_id", F.array_join("subgraphs", ",").alias("subgraphs"), "subgraph")


@query(with_views("v_nodes v_views", """
select view, label, count(*) as n from v_nodes join v_views using (label) group by view, label
union all select view, null, count(*) from v_nodes join v_views using (label) group by view
union all select null, null, count(*) from v_nodes where label in (select label from v_views)
"""))
def view_stats(t: Tables) -> DataFrame:
    return views.view_stats(_assigned(t))


@query(with_views("v_nodes v_views", "select label, 'ontology' as missing_in from (select label from v_views union select 'ghost' except select label from v_nodes) union all select label, 'mapping' from (select label from v_nodes except select label from v_views)"))
def view_missing(t: Tables) -> DataFrame:
    mapping = t.views().unionByName(t.spark.createDataFrame([(2, "GEO", "ghost")], "view_order int, view string, label string"))
    return views.mapping_differences(mapping, t.nodes())


@query(with_views("v_nodes v_views", "select id as entity_id from v_nodes where label in (select label from v_views) and label not in (select label from v_views where label <> 'region')"))
def view_uncovered(t: Tables) -> DataFrame:
    """Views were assigned before the mapping knew regions."""
    before = views.assign_views(t.nodes().select(F.col("id").alias("entity_id"), "label"), t.views().where("label <> 'region'"))
    return views.uncovered(before, t.views()).select("entity_id")


@query("""values ('label ghost is in no view'), ('projection GEO: gone is not defined'), ('triple (ghost, moves, nation): moves is not defined'), ('view GEO has nation twice'), ('view SALES has no labels'), ('view label extra is not defined'), ('views are [''GEO'', ''SALES''], not [''EBM'', ''EEM'', ''MPU'']')""".join(["select col0 as problem from (", ")"]))
def ontology_problems(t: Tables) -> DataFrame:
    """What is wrong with an ontology that breaks most rules."""
    broken = Ontology({"ghost": {}, "nation": {}}, ["located_in"], [("ghost", "moves", "nation", ["all"], "low")], [], {"GEO": ["nation", "nation", "extra"], "SALES": []}, {"Other": (None, [])}, {"GEO": (["nation"], ["gone"])})
    return t.spark.createDataFrame([(x,) for x in problems(broken)["errors"]], "problem string")


# --- resolution and centrality ---------------------------------------------


@query("select doc_id, min(doc_id) over (partition by lang, lower(trim(text))) as canonical from documents")
def exact_resolve(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", "lang", F.sha2(F.lower(F.trim("text")), 256).alias("k"))
    return resolve.canonical_ids(rows, ["lang", "k"], "doc_id")


_WCC = "c as (select src as component, dst as node from v_similar where src not in (select dst from v_similar) union select distinct src, src from v_similar where src not in (select dst from v_similar))"


@query(with_views("v_similar", "select node, component from c", _WCC))
def wcc_components(t: Tables) -> DataFrame:
    return connected_components(t.similar())


@query(with_views("v_similar", "select count(distinct component) as masters, count(*) as links from c", _WCC))
def wcc_masters(t: Tables) -> DataFrame:
    return resolve.master_stats(resolve.component_masters(t.similar()))


@query(with_views("v_geo_nodes v_geo_edges", """
select 'GEO' as view, (select count(*) from v_geo_nodes) as nodes, (select count(*) from v_geo_edges) as relationships
union all select 'SUPPLY', (select count(*) from v_nodes where label in ('part', 'supplier', 'nation')), (select count(*) from v_edges e join v_nodes s on s.id = e.src join v_nodes d on d.id = e.dst where s.label in ('part', 'supplier', 'nation') and d.label in ('part', 'supplier', 'nation') and e.rel_type in ('supplied_by', 'located_in'))
"""))
def proj_counts(t: Tables) -> DataFrame:
    labels = t.views().where("view = 'SUPPLY'").select("label")
    types = t.spark.createDataFrame([("supplied_by",), ("located_in",)], "rel_type string")
    return central.view_counts({"GEO": t.geography(), "SUPPLY": central.project(t.nodes(), t.edges(), labels, types)})


@query(with_views("v_degree", "select id, degree from v_degree"))
def degree(t: Tables) -> DataFrame:
    return central.degree(*t.geography())


def _pagerank_sql(nodes: str, edges: str, views_: str) -> str:
    steps = [f"r0 as (select id, 0.15::double as r from {nodes})", f"od as (select src, count(*) as n from {edges} group by src)"]
    for k in range(20):
        steps.append(f"r{k + 1} as (select n.id, 0.15 + 0.85 * coalesce(c.s, 0) as r from {nodes} n left join (select e.dst, sum(r{k}.r / od.n) as s from {edges} e join r{k} on r{k}.id = e.src join od on od.src = e.src group by e.dst) c on c.dst = n.id)")
    return with_views(views_, "select id, round(r + 1e-9, 6) as pagerank from r20", ",\n".join(steps))


# Ranks can end exactly half way between two roundings; the tiny shift decides those alike in both engines.
@query(_pagerank_sql("v_geo_nodes", "v_geo_edges", "v_geo_nodes v_geo_edges"))
def pagerank(t: Tables) -> DataFrame:
    return central.pagerank(*t.geography()).select("id", F.round(F.col("pagerank") + 1e-9, 6).alias("pagerank"))


@query(_pagerank_sql("v_cyc_nodes", "v_cyc_edges", "v_cyc_nodes v_cyc_edges"))
def pagerank_cyclic(t: Tables) -> DataFrame:
    return central.pagerank(*t.cyclic()).select("id", F.round(F.col("pagerank") + 1e-9, 6).alias("pagerank"))


_WALKS = """
walk as (select id as src, id as dst, 0 as d, 1.0::double as sigma from {n}
  union all select w.src, e.dst, w.d + 1, sum(w.sigma) from walk w join {e} e on e.src = w.dst where w.d < {bound} group by w.src, e.dst, w.d),
near as (select src, dst, min(d) as d from walk group by src, dst),
sp as (select w.src, w.dst, w.d, sum(w.sigma) as sigma from walk w join near on near.src = w.src and near.dst = w.dst and near.d = w.d group by w.src, w.dst, w.d)
"""


def _walks(n: str, e: str, bound: int) -> str:
    return _WALKS.format(n=n, e=e, bound=bound)


_CLOSE = "select n.id, round(coalesce(c.c, 0), 6) as closeness from {n} n left join (select dst, count(*) / sum(d)::double as c from sp where d > 0 group by dst) c on c.dst = n.id"
_BETWEEN = "select n.id, round(coalesce(b.b, 0), 6) as betweenness from {n} n left join (select a.dst as id, sum(a.sigma * z.sigma / w.sigma) as b from sp a join sp z on z.src = a.dst join sp w on w.src = a.src and w.dst = z.dst where a.d > 0 and z.d > 0 and w.d > 0 and a.d + z.d = w.d group by a.dst) b on b.id = n.id"


@query(with_views("v_geo_nodes v_geo_edges", _CLOSE.format(n="v_geo_nodes"), _walks("v_geo_nodes", "v_geo_edges", 4), recursive=True))
def closeness(t: Tables) -> DataFrame:
    nodes, edges = t.geography()
    return central.closeness(nodes, central.shortest_paths(nodes, edges)).select("id", F.round("closeness", 6).alias("closeness"))


@query(with_views("v_geo_nodes v_geo_edges", _BETWEEN.format(n="v_geo_nodes"), _walks("v_geo_nodes", "v_geo_edges", 4), recursive=True))
def betweenness(t: Tables) -> DataFrame:
    """Of the whole supplier, nation and region view."""
    nodes, edges = t.geography()
    return central.betweenness(nodes, edges, settle(central.shortest_paths(nodes, edges))).select("id", F.round("betweenness", 6).alias("betweenness"))


@query(with_views("v_cyc_nodes v_cyc_edges", _CLOSE.format(n="v_cyc_nodes"), _walks("v_cyc_nodes", "v_cyc_edges", 8), recursive=True))
def closeness_cyclic(t: Tables) -> DataFrame:
    nodes, edges = t.cyclic()
    return central.closeness_by_reach(nodes, edges).select("id", F.round("closeness", 6).alias("closeness"))


@query(with_views("v_geo_nodes v_degree", """
select id, round(dn, 6) as degree_norm, round(vn, 6) as size_norm, round((dn + vn) / 2, 6) as combined from (
  select id, (degree - lo) / (hi - lo + 1e-10) as dn, (v - vlo) / (vhi - vlo + 1e-10) as vn
  from (select id, degree, length(id)::double as v from v_degree) cross join (select min(degree) as lo, max(degree) as hi, min(length(id))::double as vlo, max(length(id))::double as vhi from v_degree))
"""))
def minmax_combined(t: Tables) -> DataFrame:
    """The degree and, as a second measure, the length of the id."""
    rows = central.degree(*t.geography()).withColumn("size", F.length("id").cast("double"))
    out = central.combine(rows, ["degree", "size"])
    return out.select("id", *[F.round(c, 6).alias(c) for c in ("degree_norm", "size_norm", "combined")])


# --- templates and paths ---------------------------------------------------

_COUNTED = "tc as (select t.view, t.subject, t.relation, t.object, count(e.src) as n from v_templates t left join (select e.src, e.rel_type, s.label as sl, d.label as dl from v_edges e join v_nodes s on s.id = e.src join v_nodes d on d.id = e.dst) e on e.rel_type = t.relation and e.sl = t.subject and e.dl = t.object group by all)"


def _counted(t: Tables) -> DataFrame:
    return paths.template_counts(t.templates(), t.edges(), t.nodes().select("id", "label"))


@query(with_views("v_nodes v_edges v_templates", "select view, subject, relation, object, n from tc", _COUNTED))
def template_counts(t: Tables) -> DataFrame:
    return _counted(t)


@query(with_views("v_nodes v_edges v_templates", "select view, subject, relation, object from tc where n = 0 order by view, subject, relation, object limit 10", _COUNTED))
def template_zero(t: Tables) -> DataFrame:
    """The report of the first ten templates without an instance."""
    return paths.zero_templates(_counted(t)).drop("n")


@query(with_views("v_nodes v_edges v_templates", "select view, count(*) filter (where n > 0) as matched, count(*) as total, count(*) filter (where n = 0) as zero, sum(n)::bigint as instances from tc group by view", _COUNTED))
def template_by_view(t: Tables) -> DataFrame:
    return paths.template_summary(_counted(t))


# degrees play the ranks: of all edges in SALES and SUPPLY, while GEO ranks only nations and regions
_RANKS = """
allrank as (select n.id, count(e.src)::double as r from v_nodes n left join v_edges e on e.src = n.id group by n.id),
cen as (select v.view, n.id as entity_id, a.r as rank, v.view_order from v_nodes n join v_views v on v.label = n.label join allrank a on a.id = n.id where v.view <> 'GEO' or n.label in ('nation', 'region')),
br as (select x.view, e.entity_id, coalesce(c.rank, e.first) as rank
  from (select entity_id, arg_min(rank, view_order) as first from cen group by entity_id) e cross join (select distinct view from v_views) x left join cen c on c.entity_id = e.entity_id and c.view = x.view)
"""
_ORDER = ["SALES", "SUPPLY", "GEO"]


def _centrality(t: Tables) -> DataFrame:
    out = t.edges().groupBy("src").agg(F.count("*").alias("n"))
    ranked = t.nodes().select("id", "label").join(out, F.col("id") == F.col("src"), "left").select("id", "label", F.coalesce("n", F.lit(0)).cast("double").alias("pagerank"))
    both = ranked.join(F.broadcast(t.views()), "label").where("view <> 'GEO' or label in ('nation', 'region')")
    return both.select("view", F.col("id").alias("entity_id"), "pagerank")


@query(with_views("v_nodes v_edges v_views", "select view, count(rank) as ranked from cen group by view", _RANKS))
def rank_presence(t: Tables) -> DataFrame:
    return paths.rank_presence(_centrality(t))


_LOW = _RANKS.strip() + """,
low as (select t.view, e.rel_id, e.src, e.dst, s.name || ' ' || e.rel_type || ' ' || d.name as text, sha256(t.view || '|' || e.rel_id) as mp_id
  from v_edges e join v_nodes s on s.id = e.src join v_nodes d on d.id = e.dst join v_templates t on t.subject = s.label and t.relation = e.rel_type and t.object = d.label)
"""


def _low(t: Tables) -> DataFrame:
    return paths.low_paths(t.edges(), t.nodes(), t.templates(), paths.best_rank(_centrality(t), _ORDER))


@query(with_views("v_nodes v_edges v_views v_templates", "select mp_id, view, rel_id, src, dst, text from low", _LOW))
def paths_low(t: Tables) -> DataFrame:
    return _low(t).drop("max_pagerank")


@query(with_views("v_nodes v_edges v_views v_templates", "select l.mp_id, greatest(a.rank, b.rank) as max_pagerank from low l left join br a on a.view = l.view and a.entity_id = l.src left join br b on b.view = l.view and b.entity_id = l.dst", _LOW))
def path_max_rank(t: Tables) -> DataFrame:
    return _low(t).select("mp_id", "max_pagerank")


_MID = """
mid as (select sha256('SALES|mid|' || o.src) as mp_id, 'SALES' as view, row_number() over (order by o.src) as counter, o.src as anchor_id, count(*) as n_members, s.name || ': ' || string_agg(p.name, ', ' order by p.name, o.dst) as text
  from v_edges o join v_nodes s on s.id = o.src join v_nodes p on p.id = o.dst where o.rel_type = 'contains' group by o.src, s.name)
"""


def _mid(t: Tables) -> DataFrame:
    """Orders play the plans and parts the steps."""
    name = lambda k: t.nodes().select(F.col("id").alias(f"{k}_id"), F.col("name").alias(f"{k}_name"))
    steps = t.edges().where("rel_type = 'contains'").select(F.lit("SALES").alias("view"), F.lit(0).alias("kind"), F.col("src").alias("anchor_id"), F.col("dst").alias("member_id"))
    return paths.mid_paths(steps.join(name("anchor"), "anchor_id").join(name("member"), "member_id"), paths.best_rank(_centrality(t), _ORDER))


@query(with_views("v_nodes v_edges", "select mp_id, view, counter, anchor_id, n_members, text from mid", _MID))
def paths_mid(t: Tables) -> DataFrame:
    return _mid(t).drop("kind", "max_pagerank")


@query(with_views("v_nodes v_edges", "select row_number() over (order by kind, anchor) as counter, kind, anchor as anchor_id, n_members, a.name || ': ' || members as text from one join v_nodes a on a.id = anchor", """
g as (select case when rel_type = 'in_region' then 1 else 0 end as kind, case when rel_type = 'in_region' then dst else src end as anchor, case when rel_type = 'in_region' then src else dst end as member from v_edges where rel_type in ('supplied_by', 'in_region')),
one as (select kind, anchor, count(*) as n_members, string_agg(coalesce(n.name, member), ', ' order by n.name, member) as members from g join v_nodes n on n.id = member group by kind, anchor)
"""))
def paths_mid_kinds(t: Tables) -> DataFrame:
    """Parts play the plans and regions the containers of one view, whose counters go on from the plans'."""
    name = lambda k: t.nodes().select(F.col("id").alias(f"{k}_id"), F.col("name").alias(f"{k}_name"))
    plans = t.edges().where("rel_type = 'supplied_by'").select(F.lit("SUPPLY").alias("view"), F.lit(0).alias("kind"), F.col("src").alias("anchor_id"), F.col("dst").alias("member_id"))
    holds = t.edges().where("rel_type = 'in_region'").select(F.lit("SUPPLY").alias("view"), F.lit(1).alias("kind"), F.col("dst").alias("anchor_id"), F.col("src").alias("member_id"))
    groups = plans.unionByName(holds).join(name("anchor"), "anchor_id").join(name("member"), "member_id")
    return paths.mid_paths(groups, paths.best_rank(_centrality(t), _ORDER)).select("counter", "kind", "anchor_id", "n_members", "text")


@query(with_views("v_nodes v_edges v_views v_templates", "select l.mp_id from low l left join own a on a.view = l.view and a.entity_id = l.src left join own b on b.view = l.view and b.entity_id = l.dst where a.rank is null and b.rank is null", _LOW.rstrip() + ",\nown as (select * from cen where not (view = 'GEO' and entity_id like 'N%'))"))
def paths_unranked(t: Tables) -> DataFrame:
    """Low paths without a rank in their own view, where nations have none in GEO: what the check of levels looks for."""
    own = _centrality(t).where("not (view = 'GEO' and entity_id like 'N%')").select("view", "entity_id", F.col("pagerank").alias("rank"))
    return paths.low_paths(t.edges(), t.nodes(), t.templates(), own).where("max_pagerank is null").select("mp_id")


@query(with_views("v_nodes v_edges v_views v_templates", "select mp_id, 'What is known about: ' || text || '?' as query from low", _LOW))
def path_queries(t: Tables) -> DataFrame:
    return paths.path_sentences(_low(t).withColumn("query", F.lit(None).cast("string"))).select("mp_id", "query")


_LINK = """
lnk as (select distinct m.anchor_id as mid_anchor, l.rel_id from (select distinct 'S' || l_suppkey as anchor_id, 'SUPPLY' as view from lineitem) m
  join v_from_chunk a on a.entity_id = m.anchor_id
  join v_from_chunk b on b.chunk_id = a.chunk_id
  join (select e.rel_id, unnest([e.src, e.dst]) as entity_id from v_edges e where e.rel_type = 'located_in' and e.src like 'S%') l on l.entity_id = b.entity_id)
"""


def _links(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All suppliers play the anchors; the low paths are the suppliers' nations."""
    mid = t.lineitem.select(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("anchor_id")).distinct().select(F.col("anchor_id").alias("mp_id"), F.lit("SUPPLY").alias("view"), "anchor_id")
    low = t.edges().where("rel_type = 'located_in' and src like 'S%'").select(F.col("rel_id").alias("mp_id"), F.lit("SUPPLY").alias("view"), "src", "dst")
    return low, mid, paths.link_paths(mid, low, t.from_chunk())


@query(with_views("v_edges v_from_chunk", "select mid_anchor as mid_id, rel_id as low_id from lnk", _LINK))
def path_links(t: Tables) -> DataFrame:
    return _links(t)[2]


@query(with_views("v_edges v_from_chunk", "select (select count(*) from v_edges where rel_type = 'located_in' and src like 'S%') as low_paths, (select count(distinct l_suppkey) from lineitem) as mid_paths, (select count(*) from lnk) as has_detail_path", _LINK))
def path_counts(t: Tables) -> DataFrame:
    return paths.path_counts(*_links(t))


@query("""
with q as (select vec_id as query_id, embedding::double[] as q from embeddings where vec_id % 50 = 0),
s as (select q.query_id, e.vec_id as id, list_cosine_similarity(e.embedding::double[], q.q) as s from q join embeddings e on e.vec_id <> q.query_id)
select query_id, rank::int as rank, id, round(s, 6) as score from (select *, row_number() over (partition by query_id order by s desc, id) as rank from s) where rank <= 3
""")
def path_knn(t: Tables) -> DataFrame:
    """Every vector whose id 50 divides asks all others."""
    rows = t.embeddings.select(F.col("vec_id").alias("id"), "embedding")
    found = retrieval.nearest_by_cosine(rows, rows.where("id % 50 = 0"))
    return found.select("query_id", "rank", "id", F.round("score", 6).alias("score"))


@query("select token, doc_id as id, count(*) as tf from (select doc_id, unnest(regexp_extract_all(lower(text), '([\\p{L}\\p{N}_]+)')) as token from documents) group by token, doc_id")
def keyword_index(t: Tables) -> DataFrame:
    return retrieval.keyword_postings(t.documents.select(F.col("doc_id").alias("id"), "text"))


@query("select id, count(*) as hits, sum(tf)::bigint as tf from (select doc_id as id, token, count(*) as tf from (select doc_id, unnest(regexp_extract_all(lower(text), '([\\p{L}\\p{N}_]+)')) as token from documents) where token in ('the', 'der', 'de') group by doc_id, token) group by id order by hits desc, tf desc, id limit 10")
def keyword_topk(t: Tables) -> DataFrame:
    """The ten documents that keyword search ranks first."""
    return retrieval.keyword_search(keyword_index(t), ["the", "der", "de"])


# --- reports, events, vocabulary -------------------------------------------


@query(with_views("v_nodes v_edges", "select (select count(*) from v_nodes) + (select count(*) from documents) as nodes, (select count(*) from v_edges) as relationships, (select count(*) from documents) as chunks, 0::bigint as metapaths"))
def db_stats(t: Tables) -> DataFrame:
    from loomgraph.model import KnowledgeGraph

    return KnowledgeGraph.empty(t.spark, entities=t.nodes().select(F.col("id").alias("entity_id")), relations=t.edges(), chunks=t.chunks()).stats()


@query("select user_id, r.event_id as event_id, r.event_type as event_type, r.value as value from (select user_id, arg_max({'event_id': event_id, 'event_type': event_type, 'value': value}, (epoch_us(ts), event_id)) as r from events group by user_id)")
def event_latest(t: Tables) -> DataFrame:
    return events.latest_by(t.events, "user_id", ["ts", "event_id"], ["event_id", "event_type", "value"])


@query("""
with e as (select user_id::varchar as run_id, event_id as seq, event_type, case event_type when 'signup' then 'stage_start' when 'purchase' then 'error' when 'login' then 'stage_done' else 'log' end as type from events)
select run_id, max(seq) as last_seq, arg_max(event_type, seq) filter (where type = 'error') as last_error from e group by run_id
""")
def run_states(t: Tables) -> DataFrame:
    """Users play the runs and their event types the kinds of progress events."""
    kind = F.expr("case event_type when 'signup' then 'stage_start' when 'purchase' then 'error' when 'login' then 'stage_done' else 'log' end")
    none = F.lit(None)
    rows = t.events.select(F.col("user_id").cast("string").alias("run_id"), F.col("event_id").alias("seq"), kind.alias("type"), F.col("event_type").alias("stage"), none.cast("int").alias("index"), none.cast("int").alias("total"), F.col("event_type").alias("message"))
    return events.run_states(rows).select("run_id", "last_seq", "last_error")


@query("select user_id, case when n > 0 then 'success' else 'failed' end as status, n as n_ok from (select user_id, count(*) filter (where event_type = 'purchase') as n from events group by user_id)")
def doc_status(t: Tables) -> DataFrame:
    return checks.document_status(t.events.withColumn("ok", F.col("event_type") == "purchase"), doc="user_id")


@query(with_views("v_edges", "select src as a, dst as b, rel_type from v_edges union all select dst, src, rel_type from v_edges where src <> dst"))
def undirected_edges(t: Tables) -> DataFrame:
    e = t.edges()
    return e.select(F.col("src").alias("a"), F.col("dst").alias("b"), "rel_type").unionByName(e.where("src <> dst").select(F.col("dst").alias("a"), F.col("src").alias("b"), "rel_type"))


@query(with_views("v_nodes v_edges", "select n.id, e.dst as neighbour from v_nodes n left join v_edges e on e.src = n.id and e.rel_type = 'supplied_by' where n.label in ('part', 'supplier')"))
def neighbours_optional(t: Tables) -> DataFrame:
    own = t.nodes().where("label in ('part', 'supplier')").select("id")
    far = t.edges().where("rel_type = 'supplied_by'").select(F.col("src").alias("id"), F.col("dst").alias("neighbour"))
    return own.join(far, "id", "left")


@query("select * from (values " + ", ".join(f"({k}, '{a}', '{r}', '{b}')" for k, (a, r, b, *_) in enumerate(default_ontology().triples, 1)) + ") x(template_id, subject, relation, object)")
def ontology_templates(t: Tables) -> DataFrame:
    """The built-in extraction templates that the ontology admits."""
    f = default_ontology().frames(t.spark)
    return extraction.usable_templates(f["triple_template"], f["entity_def"], f["relation_def"]).select("template_id", "subject", "relation", "object")


def flagship(t: Tables) -> DataFrame:
    """Per file: chunks of the Markdown, with heading paths and roles, without duplicates, and their chain."""
    docs = t.markdown()
    chunks = chunking.infer_roles(chunking.chunk_documents(docs, text="md", header_paths=True).withColumnRenamed("chunk", "text"))
    rows = chunks.select(F.concat_ws("#", F.col("doc_id").cast("string"), F.col("chunk_id").cast("string")).alias("chunk_id"), "filename", (F.col("doc_id") * 100_000 + F.col("chunk_id")).alias("index"), "text", "header_path", "section_role")
    rows = settle(rows)
    kept = dedup.drop_duplicates(rows)
    links = dedup.next_chunks(kept).groupBy("filename").agg(F.count("*").alias("links"))
    per = rows.groupBy("filename").agg(F.count("*").alias("chunks"), F.count_distinct("header_path").alias("header_paths"))
    left = kept.groupBy("filename").agg(F.count("*").alias("kept"))
    return per.join(left, "filename").join(links, "filename", "left").select("filename", "chunks", "kept", F.coalesce("links", F.lit(0)).alias("links"), "header_paths")

