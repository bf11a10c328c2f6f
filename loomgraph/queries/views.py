"""The graph and Markdown views that the queries read, in Spark and as SQL.

Documents have no headings, so every fifth line becomes one and every third
line ends in a blank line.  Customers, orders, parts, suppliers, nations and
regions are the typed nodes; orders play the chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The views' labels, and the projection that ranks are taken on.
VIEW_LABELS = [(0, "SALES", "customer"), (0, "SALES", "order"), (0, "SALES", "part"), (1, "SUPPLY", "part"), (1, "SUPPLY", "supplier"), (1, "SUPPLY", "nation"), (2, "GEO", "nation"), (2, "GEO", "region"), (2, "GEO", "supplier"), (2, "GEO", "customer")]
TEMPLATES = [("SALES", "customer", "placed", "order"), ("SALES", "order", "contains", "part"), ("SUPPLY", "part", "supplied_by", "supplier"), ("SUPPLY", "supplier", "located_in", "nation"), ("GEO", "supplier", "located_in", "nation"), ("GEO", "customer", "located_in", "nation"), ("GEO", "nation", "in_region", "region"), ("GEO", "nation", "placed", "part")]
PRIORS = {"Abstract": ["EBM", "EEM", "MPU"], "Introduction": ["EBM", "MPU"], "Methods_Materials": ["EBM", "EEM"], "Results": ["EBM", "EEM", "MPU"], "Discussion": ["MPU"], "Conclusion": ["MPU"], "References": ["MPU"], "Other": []}


class Tables:
    """The tables of one folder, read with only the columns that a query uses."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def markdown(self) -> DataFrame:
        md = F.expr("array_join(transform(split(text, '\\n'), (l, i) -> case when i % 5 = 0 then concat(repeat('#', cast(1 + ((i div 5) % 3) as int)), ' ', l) when (i + 1) % 3 = 0 then concat(l, '\\n') else l end), '\\n')")
        return self.documents.select("doc_id", F.col("lang").alias("filename"), md.alias("md"))

    def chunks(self) -> DataFrame:
        """Documents as chunks of the file of their language."""
        return self.documents.select(F.col("doc_id").alias("chunk_id"), F.col("lang").alias("filename"), F.col("doc_id").cast("int").alias("index"), "text")

    def nodes(self) -> DataFrame:
        one = lambda t, p, k, label, name: getattr(self, t).select(F.concat(F.lit(p), F.col(k).cast("string")).alias("id"), F.lit(label).alias("label"), F.col(name).cast("string").alias("name"))
        out = one("customer", "C", "c_custkey", "customer", "c_name")
        for args in (("orders", "O", "o_orderkey", "order", "o_orderkey"), ("part", "P", "p_partkey", "part", "p_name"), ("supplier", "S", "s_suppkey", "supplier", "s_name"), ("nation", "N", "n_nationkey", "nation", "n_name"), ("region", "R", "r_regionkey", "region", "r_name")):
            out = out.unionByName(one(*args))
        return out

    def edges(self) -> DataFrame:
        key = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
        one = lambda df, rel, s, d: df.select(key(*s).alias("src"), F.lit(rel).alias("rel_type"), key(*d).alias("dst"))
        parts = [
            one(self.orders, "placed", ("C", "o_custkey"), ("O", "o_orderkey")),
            one(self.lineitem.select("l_orderkey", "l_partkey").distinct(), "contains", ("O", "l_orderkey"), ("P", "l_partkey")),
            one(self.lineitem.select("l_partkey", "l_suppkey").distinct(), "supplied_by", ("P", "l_partkey"), ("S", "l_suppkey")),
            one(self.supplier, "located_in", ("S", "s_suppkey"), ("N", "s_nationkey")),
            one(self.customer, "located_in", ("C", "c_custkey"), ("N", "c_nationkey")),
            one(self.nation, "in_region", ("N", "n_nationkey"), ("R", "n_regionkey")),
        ]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.withColumn("rel_id", F.concat_ws("|", "src", "rel_type", "dst"))

    def from_chunk(self) -> DataFrame:
        key = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
        pairs = [self.lineitem.select(key("P", "l_partkey").alias("entity_id"), key("O", "l_orderkey").alias("chunk_id")), self.lineitem.select(key("S", "l_suppkey").alias("entity_id"), key("O", "l_orderkey").alias("chunk_id")), self.orders.select(key("C", "o_custkey").alias("entity_id"), key("O", "o_orderkey").alias("chunk_id"))]
        return pairs[0].unionByName(pairs[1]).unionByName(pairs[2]).distinct()

    def views(self) -> DataFrame:
        return self.spark.createDataFrame(VIEW_LABELS, "view_order int, view string, label string")

    def templates(self) -> DataFrame:
        return self.spark.createDataFrame(TEMPLATES, "view string, subject string, relation string, object string")

    def priors(self) -> DataFrame:
        return self.spark.createDataFrame([(k, v) for k, v in PRIORS.items()], "section_role string, roles array<string>")

    def similar(self) -> DataFrame:
        """Each document and the first one of equal text: as connected as all pairs, without being them."""
        key = F.sha2("text", 256).alias("k")
        first = self.documents.groupBy(key).agg(F.min("doc_id").alias("src"))
        return self.documents.select("doc_id", key).join(first, "k").where("src < doc_id").select("src", F.col("doc_id").alias("dst"))

    def geography(self) -> tuple[DataFrame, DataFrame]:
        """The view GEO as (id) and (src, dst)."""
        from loomgraph.graph.centrality import project

        labels = self.spark.createDataFrame([(label,) for _, view, label in VIEW_LABELS if view == "GEO"], "label string")
        types = self.spark.createDataFrame([("located_in",), ("in_region",)], "rel_type string")
        return project(self.nodes(), self.edges(), labels, types)

    def cyclic(self) -> tuple[DataFrame, DataFrame]:
        """A graph with cycles of all lines: from the node of the part's key to that of the supplier's."""
        edges = self.lineitem.select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst")).where("src <> dst").distinct()
        return self.lineitem.select(F.explode(F.array("l_partkey", "l_suppkey")).alias("id")).distinct(), edges


_VALUES = lambda rows: ", ".join("(" + ", ".join(repr(x) for x in r) + ")" for r in rows)

SQL = {
    "v_md": "select doc_id, lang as filename, array_to_string(list_transform(string_split(text, chr(10)), lambda l, i: case when i % 5 = 1 then repeat('#', 1 + ((i // 5) % 3)::int) || ' ' || l when i % 3 = 0 then l || chr(10) else l end), chr(10)) as md from documents",
    "v_lines": "select doc_id, filename, i, ls[i] as line from (select doc_id, filename, string_split(md, chr(10)) as ls, unnest(range(1, len(string_split(md, chr(10))) + 1)) as i from v_md)",
    "v_nodes": "select 'C' || c_custkey as id, 'customer' as label, c_name as name from customer union all select 'O' || o_orderkey, 'order', o_orderkey::varchar from orders union all select 'P' || p_partkey, 'part', p_name from part union all select 'S' || s_suppkey, 'supplier', s_name from supplier union all select 'N' || n_nationkey, 'nation', n_name from nation union all select 'R' || r_regionkey, 'region', r_name from region",
    "v_edges0": "select 'C' || o_custkey as src, 'placed' as rel_type, 'O' || o_orderkey as dst from orders union all select distinct 'O' || l_orderkey, 'contains', 'P' || l_partkey from lineitem union all select distinct 'P' || l_partkey, 'supplied_by', 'S' || l_suppkey from lineitem union all select 'S' || s_suppkey, 'located_in', 'N' || s_nationkey from supplier union all select 'C' || c_custkey, 'located_in', 'N' || c_nationkey from customer union all select 'N' || n_nationkey, 'in_region', 'R' || n_regionkey from nation",
    "v_edges": "select *, src || '|' || rel_type || '|' || dst as rel_id from v_edges0",
    "v_from_chunk": "select 'P' || l_partkey as entity_id, 'O' || l_orderkey as chunk_id from lineitem union select 'S' || l_suppkey, 'O' || l_orderkey from lineitem union select 'C' || o_custkey, 'O' || o_orderkey from orders",
    "v_views(view_order, view, label)": f"values {_VALUES(VIEW_LABELS)}",
    "v_templates(view, subject, relation, object)": f"values {_VALUES(TEMPLATES)}",
    "v_priors(section_role, roles)": "values " + ", ".join(f"('{k}', '{','.join(v)}')" for k, v in PRIORS.items()),
    "v_similar": "select a.doc_id as src, b.doc_id as dst from documents a join documents b on a.text = b.text and a.doc_id < b.doc_id",
    "v_geo_nodes": "select id from v_nodes where label in ('supplier', 'nation', 'region', 'customer')",
    "v_geo_edges": "select src, dst from v_edges where rel_type in ('located_in', 'in_region') and src in (select id from v_geo_nodes) and dst in (select id from v_geo_nodes)",
    "v_cyc_edges": "select distinct l_partkey as src, l_suppkey as dst from lineitem where l_partkey <> l_suppkey",
    "v_cyc_nodes": "select l_partkey as id from lineitem union select l_suppkey from lineitem",
    "v_degree": "select n.id, count(e.src)::double as degree from v_geo_nodes n left join v_geo_edges e on e.src = n.id group by n.id",
}
_NEEDS = {"v_lines": ["v_md"], "v_edges": ["v_edges0"], "v_geo_nodes": ["v_nodes"], "v_geo_edges": ["v_edges", "v_geo_nodes"], "v_degree": ["v_geo_nodes", "v_geo_edges"]}


def with_views(names: str, query: str, extra: str = "", recursive: bool = False) -> str:
    """query behind the common table expressions of the views named, and of those that they use."""
    order: list[str] = []

    def add(name: str) -> None:
        for n in _NEEDS.get(name, []):
            add(n)
        if name not in order:
            order.append(name)

    for name in names.split():
        add(name)
    full = {k.split("(")[0]: k for k in SQL}
    parts = [f"{full[n]} as ({SQL[full[n]]})" for n in order] + ([extra.strip()] if extra else [])
    return ("with recursive " if recursive else "with ") + ",\n".join(parts) + "\n" + query
