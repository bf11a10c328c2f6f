"""Keyword rules: section roles, evidence sentences, names and weights."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomgraph.functions.text import let, record, strip
from loomgraph.ontology import SECTION_ALIASES

# Rules in order; the first that matches wins.  Keywords are plain substrings.
SECTION_RULES = [
    ("Abstract", [
        "abstract", "摘要", "概述", "summary", "文摘",
    ], None),
    ("Introduction", [
        "introduction", "引言", "前言", "绪论", "背景", "background", "研究背景", "概况", "overview",
    ], r"^1\."),
    ("Methods_Materials", [
        "method", "material", "procedure", "experiment", "experimental", "sampling", "analysis", "measurement", "instrument", "equipment", "protocol",
        "technique", "preparation", "方法", "材料", "实验", "样品", "检测", "质量控制", "质控", "设备", "仪器", "采样", "分析方法", "测定", "试剂", "操作", "步骤", "流程", "制备", "处理",
        "测试",
    ], r"^2\."),
    ("Results", [
        "result", "finding", "data", "table", "figure", "fig", "content", "concentration", "level", "distribution", "observation", "outcome", "结果",
        "数据", "含量", "浓度", "水平", "分布", "检出", "测定结果", "测量", "观察", "表", "图",
    ], r"^3\.(?!\d)"),
    ("Discussion", [
        "discussion", "interpretation", "implication", "analysis", "risk", "exposure", "assessment", "evaluation", "impact", "health", "safety",
        "hazard", "讨论", "分析", "评价", "风险", "暴露", "影响", "健康", "安全", "危害", "机制", "原因", "比较",
    ], r"^3\.\d+\."),
    ("Conclusion", [
        "conclusion", "summary", "closing", "outlook", "perspective", "结论", "总结", "小结", "展望", "建议", "对策",
    ], r"^[45]\."),
    ("References", [
        "reference", "bibliography", "bibliographies", "citation", "literature", "literature cited", "works cited", "参考文献", "文献", "引用",
    ], None),
]
TEXT_RULES = [
    ("Methods_Materials", [
        "we collected", "我们收集", "we used", "我们使用", "sampling was", "采样", "according to", "根据", "were analyzed", "进行分析", "measured by", "测定",
    ]),
    ("Results", [
        "p<", "p =", "p value", "p<0.", "p =0.", "significant", "显著", "was found", "发现", "showed", "显示", "indicated", "表明",
    ]),
]
WEIGHT_RULES = [
    (0.85, [
        "significant", "p<", "p =", "p<0.", "p<0.0", "显著", "cause", "lead to", "result in", "导致", "产生", "directly", "直接",
    ]),
    (0.7, [
        "associated", "correlated", "related", "linked", "相关", "关联", "indicate", "表明", "showed", "显示",
    ]),
    (0.4, [
        "may", "might", "could", "possibly", "suggest", "可能", "暗示", "unclear", "不清楚",
    ]),
]
DEFAULT_WEIGHT = 0.5
LABEL_WEIGHTS = [
    (0.85, [
        "whu_Pollutant", "mp_Claim", "whu_DataSet", "whu_EnvironmentFeature",
    ]),
    (0.75, [
        "whu_Specimen", "whu_Computational_Experiment", "whu_BioChemical_Experiment", "whu_Bio_chemical_Experiment",
    ]),
    (0.6, [
        "whu_Instrument", "whu_Method", "mp_Method", "mp_Statement",
    ]),
]
EMPHASIS = [
    "significant", "critical", "primary", "main", "key", "主要", "关键", "重要", "核心",
]
ROLES = ["Abstract", "Introduction", "Methods_Materials", "Results", "Discussion", "Conclusion", "References", "Other"]


def any_of(c: Column, keywords: list[str]) -> Column:
    return c.rlike("|".join(re.escape(k) for k in keywords))


def section_role(header: Column, text: Column) -> Column:
    """The role by the rules on the whole header path, then on the first 200 characters; null if none fits."""
    h, t = F.lower(F.coalesce(header, F.lit(""))), F.lower(F.left(F.coalesce(text, F.lit("")), F.lit(200)))
    conditions = [(role, any_of(h, words) | (h.rlike(pattern) if pattern else F.lit(False))) for role, words, pattern in SECTION_RULES]
    conditions += [(role, any_of(t, words)) for role, words in TEXT_RULES]
    return F.coalesce(*[F.when(c, role) for role, c in conditions])


def role_from_answer(answer: Column) -> Column:
    """A free answer as a role: the role itself, else the first role it contains in any case, else Other."""
    a = strip(F.coalesce(answer, F.lit("")))
    return F.coalesce(F.when(a.isin(ROLES), a), *[F.when(F.contains(F.lower(a), F.lit(r.lower())), r) for r in ROLES], F.lit("Other"))


def canonical_section(name: Column) -> Column:
    """Aliases in any case become their role; an unknown name is only trimmed, null and blank are Other."""
    bare = strip(F.coalesce(name, F.lit("")))
    table = F.create_map(*[F.lit(x) for kv in SECTION_ALIASES.items() for x in kv])
    return F.when(bare == "", "Other").otherwise(F.coalesce(F.try_element_at(table, F.lower(bare)), bare))


def evidence_sentence(chunk: Column, source: Column, target: Column) -> Column:
    """The first sentence that holds both names in any case, at most 300 characters; else the chunk's start.

    An empty or null name is held by every sentence.
    """
    told = record(text=F.coalesce(chunk, F.lit("")), a=F.lower(F.coalesce(source, F.lit(""))), b=F.lower(F.coalesce(target, F.lit(""))))

    def sentence(x):
        sentences = F.split(F.replace(x["text"], F.lit("。"), F.lit(".")), r"\.", -1)
        hit = F.get(F.filter(sentences, lambda s: let(F.lower(s), lambda l: F.contains(l, x["a"]) & F.contains(l, x["b"]))), F.lit(0))
        return F.coalesce(F.nullif(F.left(strip(hit), F.lit(300)), F.lit("")), F.concat(strip(F.left(x["text"], F.lit(200))), F.lit("...")))

    return let(told, sentence)


def relation_name(name: Column, rel_type: Column) -> Column:
    return F.coalesce(F.nullif(name, F.lit("")), F.lower(F.replace(rel_type, F.lit("_"), F.lit(" "))))


def relation_weight(weight: Column, sentence: Column) -> Column:
    """A weight that is there (0 too), else by the first keyword rule."""
    s = F.lower(F.coalesce(sentence, F.lit("")))
    rules = [F.when(any_of(s, words), F.lit(w)) for w, words in WEIGHT_RULES]
    return F.coalesce(weight, *rules, F.lit(DEFAULT_WEIGHT))


def node_weight(weight: Column, label: Column, name: Column, text: Column) -> Column:
    """A weight that is there; else by label, 0.1 more (1.0 at most) with an emphasis keyword; null without a name."""
    by_label = reduce(lambda rest, x: F.when(label.isin(x[1]), F.lit(x[0])).otherwise(rest), reversed(LABEL_WEIGHTS), F.lit(DEFAULT_WEIGHT))
    said = F.lower(F.concat(name, F.lit(" "), F.coalesce(text, F.lit(""))))
    return F.when(weight.isNotNull() | name.isNull(), weight).otherwise(F.when(any_of(said, EMPHASIS), F.least(by_label + 0.1, F.lit(1.0))).otherwise(by_label))
