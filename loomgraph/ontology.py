"""The built-in ontology, its templates and view tables, and checks on any ontology.

Files in the same shape can replace each part (see ``sources.ontology_files``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

VIEWS = ["MPU", "EBM", "EEM"]

# Label, views, and typed properties beside the two that all have.
_ENTITIES = [
    ("mp_Attribution", ["MPU"], {}),
    ("mp_References", ["MPU"], {}),
    ("whu_Computational_Experiment", ["EEM"], {}),
    ("envo_EnvironmentMaterial", ["EBM"], {}),
    ("whu_Reagent", ["EBM", "EEM"], {}),
    ("iao_ScalarMeasurementDatum", ["EEM"], {"whu_hascomparator": "STRING", "iao_hasMeasurementUnit": "STRING", "iao_hasMeasurementValue": "FLOAT"}),
    ("whu_Software", ["EEM"], {"whu_brand": "STRING", "schema_softwareVersion": "STRING"}),
    ("whu_TargetVariable", ["EEM"], {}),
    ("whu_SpecimenCollection", ["EBM"], {}),
    ("mp_Claim", ["MPU"], {}),
    ("whu_Goal", ["EEM"], {}),
    ("mp_Statement", ["MPU"], {}),
    ("whu_BioChemical_Experiment", ["EEM"], {}),
    ("whu_Device", ["EBM", "EEM"], {"schema_hasBrand": "STRING", "schema_hasModel": "STRING", "schema_hasSerialNumber": "STRING"}),
    ("whu_EnvironmentFeature", ["EBM"], {"gn_population": "INTEGER", "geo_alt": "FLOAT", "geo_lat": "FLOAT", "geo_long": "FLOAT"}),
    ("mp_Method", ["MPU", "EBM", "EEM"], {}),
    ("whu_SpecimenPreprocessing", ["EBM"], {}),
    ("whu_ProcessedSpecimen", ["EBM", "EEM"], {}),
    ("whu_DataSet", ["MPU", "EEM"], {}),
    ("whu_Specimen", ["EBM", "EEM"], {}),
    ("whu_ScienceEvidence", ["MPU"], {}),
    ("whu_ResearchStep", ["EBM", "EEM"], {"WHU_RESEARCHTYPE": "STRING"}),
    ("obi_organism", ["EBM"], {}),
    ("whu_ChemicalEntity", ["EBM", "EEM"], {}),
    ("whu_SupportGraph", ["MPU"], {}),
    ("iao_DataItem", ["EEM"], {}),
]

# Relation types.
_RELATIONS = [
    "mp_supports",
    "whu_declaredUsed",
    "p_plan_correspondsToStep",
    "prov_atLocation",
    "cito_isCitedBy",
    "whu_hasGoal",
    "p_plan_isPrecededBy",
    "whu_fellow",
    "whu_hasTarget",
    "p_plan_isInputVarOf",
    "p_plan_isOutputVarOf",
    "prov_wasDerivedFrom",
    "dcterms_hasPart",
    "mp_challenges",
    "iao_is_about",
    "p_plan_isStepOfPlan",
    "prov_hadMember",
    "bfo_has_part",
    "whu_declaredInput",
    "whu_declaredOutput",
    "whu_hasContext",
]

# Subject, relation, object, sections, tier.
_TRIPLES = [
    ("mp_Attribution", "mp_supports", "whu_DataSet", ["Results", "Discussion"], "mid2low"),
    ("mp_Attribution", "mp_supports", "mp_Method", ["Methods_Materials", "Discussion"], "mid2low"),
    ("mp_Attribution", "mp_supports", "mp_Claim", ["Results", "Discussion"], "low"),
    ("mp_Attribution", "mp_supports", "mp_References", ["References", "Introduction"], "low"),
    ("mp_Attribution", "mp_supports", "mp_Statement", ["Results", "Discussion", "Introduction"], "low"),
    ("whu_ResearchStep", "whu_declaredUsed", "mp_Method", ["Methods_Materials", "Experiment"], "low"),
    ("whu_ResearchStep", "whu_declaredUsed", "whu_Device", ["Methods_Materials", "Experiment"], "low"),
    ("whu_ResearchStep", "p_plan_isPrecededBy", "whu_ResearchStep", ["Methods_Materials", "Experiment"], "low"),
    ("whu_SpecimenPreprocessing", "whu_fellow", "whu_SpecimenCollection", ["Methods_Materials"], "mid"),
    ("whu_BioChemical_Experiment", "whu_hasGoal", "whu_Goal", ["Abstract", "Introduction", "Experiment"], "mid2low"),
    ("whu_BioChemical_Experiment", "whu_fellow", "whu_SpecimenPreprocessing", ["Methods_Materials", "Experiment"], "mid"),
    ("whu_ResearchStep", "whu_declaredInput", "whu_ProcessedSpecimen", ["Methods_Materials", "Experiment"], "low"),
    ("whu_ResearchStep", "whu_declaredUsed", "whu_Reagent", ["Methods_Materials", "Experiment"], "low"),
    ("whu_Computational_Experiment", "whu_hasGoal", "whu_Goal", ["Abstract", "Introduction", "Methods_Materials", "Experiment"], "mid2low"),
    ("whu_Computational_Experiment", "whu_fellow", "whu_BioChemical_Experiment", ["Methods_Materials", "Experiment"], "mid"),
    ("whu_ResearchStep", "whu_declaredInput", "whu_DataSet", ["Methods_Materials", "Experiment"], "low"),
    ("whu_ResearchStep", "whu_declaredUsed", "whu_Software", ["Methods_Materials", "Experiment"], "low"),
    ("mp_References", "cito_isCitedBy", "whu_DataSet", ["all"], "low"),
    ("mp_References", "cito_isCitedBy", "mp_Method", ["all"], "low"),
    ("mp_References", "cito_isCitedBy", "mp_Claim", ["all"], "low"),
    ("mp_References", "cito_isCitedBy", "mp_Statement", ["all"], "low"),
    ("whu_Goal", "whu_hasTarget", "whu_TargetVariable", ["Methods_Materials", "Experiment"], "low"),
    ("whu_ProcessedSpecimen", "prov_wasDerivedFrom", "whu_Specimen", ["Methods_Materials"], "low"),
    ("whu_DataSet", "dcterms_hasPart", "iao_DataItem", ["all"], "low"),
    ("whu_DataSet", "mp_challenges", "mp_Claim", ["Results", "Discussion"], "low"),
    ("whu_DataSet", "mp_supports", "mp_Claim", ["Results", "Discussion"], "low"),
    ("whu_DataSet", "mp_challenges", "mp_Statement", ["Results", "Discussion"], "low"),
    ("whu_DataSet", "mp_supports", "mp_Statement", ["Results", "Discussion"], "low"),
    ("mp_Statement", "mp_supports", "mp_Claim", ["all"], "low"),
    ("mp_Statement", "mp_challenges", "mp_Claim", ["all"], "low"),
    ("mp_Claim", "mp_supports", "mp_Claim", ["all"], "low"),
    ("mp_Claim", "mp_challenges", "mp_Claim", ["all"], "low"),
    ("whu_ScienceEvidence", "prov_hadMember", "whu_DataSet", ["all"], "mid2low"),
    ("whu_ScienceEvidence", "prov_hadMember", "mp_Method", ["all"], "mid2low"),
    ("whu_SupportGraph", "prov_hadMember", "mp_Statement", ["all"], "mid"),
    ("whu_SupportGraph", "prov_hadMember", "mp_Attribution", ["all"], "mid"),
    ("whu_SupportGraph", "prov_hadMember", "mp_References", ["all"], "mid"),
    ("whu_ScienceEvidence", "mp_supports", "whu_SupportGraph", ["all"], "mid"),
    ("whu_ScienceEvidence", "mp_challenges", "whu_SupportGraph", ["all"], "mid"),
    ("whu_ResearchStep", "p_plan_isStepOfPlan", "whu_SpecimenCollection", ["Methods_Materials"], "mid2low"),
    ("whu_ResearchStep", "p_plan_isStepOfPlan", "whu_SpecimenPreprocessing", ["Methods_Materials"], "mid2low"),
    ("whu_ResearchStep", "p_plan_isStepOfPlan", "whu_BioChemical_Experiment", ["Methods_Materials", "Experiment"], "mid2low"),
    ("whu_ResearchStep", "p_plan_isStepOfPlan", "whu_Computational_Experiment", ["Methods_Materials", "Experiment"], "mid2low"),
    ("whu_EnvironmentFeature", "bfo_has_part", "envo_EnvironmentMaterial", ["Methods_Materials"], "mid2low"),
    ("whu_Specimen", "bfo_has_part", "whu_ChemicalEntity", ["Methods_Materials", "Results"], "low"),
    ("obi_organism", "bfo_has_part", "whu_ChemicalEntity", ["Methods_Materials", "Results"], "low"),
    ("envo_EnvironmentMaterial", "bfo_has_part", "whu_ChemicalEntity", ["Methods_Materials", "Results"], "low"),
    ("whu_Specimen", "prov_wasDerivedFrom", "obi_organism", ["Methods_Materials"], "low"),
    ("obi_organism", "prov_atLocation", "whu_EnvironmentFeature", ["Methods_Materials"], "mid2low"),
    ("whu_Specimen", "prov_wasDerivedFrom", "envo_EnvironmentMaterial", ["Methods_Materials"], "low"),
    ("whu_TargetVariable", "iao_is_about", "whu_ChemicalEntity", ["Methods_Materials", "Experiment"], "low"),
    ("whu_DataSet", "iao_is_about", "whu_TargetVariable", ["Results", "Experiment"], "low"),
    ("iao_DataItem", "iao_is_about", "whu_TargetVariable", ["Results", "Experiment"], "low"),
    ("iao_ScalarMeasurementDatum", "iao_is_about", "whu_TargetVariable", ["Results", "Experiment"], "low"),
    ("whu_ResearchStep", "whu_declaredOutput", "whu_Specimen", ["Methods_Materials"], "low"),
    ("whu_ResearchStep", "whu_declaredInput", "whu_Specimen", ["Methods_Materials"], "low"),
    ("whu_ResearchStep", "whu_declaredOutput", "whu_ProcessedSpecimen", ["Methods_Materials"], "low"),
    ("whu_ResearchStep", "whu_declaredOutput", "whu_DataSet", ["Methods_Materials", "Results", "Experiment"], "low"),
    ("whu_BioChemical_Experiment", "whu_fellow", "whu_BioChemical_Experiment", ["Methods_Materials", "Experiment"], "mid"),
    ("whu_Computational_Experiment", "whu_fellow", "whu_Computational_Experiment", ["Methods_Materials", "Experiment"], "mid"),
    ("whu_ResearchStep", "prov_atLocation", "whu_EnvironmentFeature", ["Methods_Materials"], "mid2low"),
    ("whu_SpecimenCollection", "whu_hasContext", "whu_EnvironmentFeature", ["Methods_Materials"], "mid"),
    ("mp_References", "mp_supports", "mp_Claim", ["Introduction", "Results", "Discussion"], "low"),
    ("mp_References", "mp_supports", "mp_Statement", ["Introduction", "Results", "Discussion"], "low"),
    ("whu_SupportGraph", "prov_hadMember", "mp_Claim", ["all"], "mid"),
    ("whu_ScienceEvidence", "mp_supports", "mp_Claim", ["Results", "Discussion"], "mid"),
    ("whu_ScienceEvidence", "mp_challenges", "mp_Claim", ["Results", "Discussion"], "mid2low"),
    ("whu_Specimen", "p_plan_isInputVarOf", "whu_SpecimenPreprocessing", ["Methods_Materials"], "mid2low"),
    ("whu_Specimen", "p_plan_isOutputVarOf", "whu_SpecimenCollection", ["Methods_Materials"], "mid2low"),
    ("whu_ProcessedSpecimen", "p_plan_isInputVarOf", "whu_BioChemical_Experiment", ["Methods_Materials", "Experiment"], "mid2low"),
    ("whu_ProcessedSpecimen", "p_plan_isOutputVarOf", "whu_SpecimenPreprocessing", ["Methods_Materials"], "mid2low"),
    ("whu_DataSet", "p_plan_isOutputVarOf", "whu_Computational_Experiment", ["Methods_Materials", "Experiment"], "mid2low"),
    ("whu_Specimen", "prov_wasDerivedFrom", "whu_EnvironmentFeature", ["Methods_Materials"], "mid2low"),
    ("whu_DataSet", "iao_is_about", "whu_Reagent", ["Methods_Materials", "Experiment"], "low"),
    ("whu_DataSet", "iao_is_about", "whu_Specimen", ["Methods_Materials"], "low"),
    ("whu_DataSet", "iao_is_about", "whu_ProcessedSpecimen", ["Methods_Materials"], "low"),
]

# View, subject, relation, object of the low-level paths.
_PATHS = [
    ("MPU", "mp_Attribution", "mp_supports", "whu_DataSet"),
    ("MPU", "mp_Attribution", "mp_supports", "mp_Method"),
    ("MPU", "mp_Attribution", "mp_supports", "mp_Claim"),
    ("MPU", "mp_Attribution", "mp_supports", "mp_References"),
    ("MPU", "mp_Attribution", "mp_supports", "mp_Statement"),
    ("EEM", "whu_ResearchStep", "whu_declaredUsed", "mp_Method"),
    ("EEM", "whu_ResearchStep", "whu_declaredUsed", "whu_Device"),
    ("EEM", "whu_ResearchStep", "p_plan_isPrecededBy", "whu_ResearchStep"),
    ("EBM", "whu_SpecimenPreprocessing", "whu_fellow", "whu_SpecimenCollection"),
    ("EEM", "whu_BioChemical_Experiment", "whu_hasGoal", "whu_Goal"),
    ("EBM", "whu_BioChemical_Experiment", "whu_fellow", "whu_SpecimenPreprocessing"),
    ("EEM", "whu_ResearchStep", "whu_declaredInput", "whu_ProcessedSpecimen"),
    ("EEM", "whu_ResearchStep", "whu_declaredUsed", "whu_Reagent"),
    ("EEM", "whu_Computational_Experiment", "whu_hasGoal", "whu_Goal"),
    ("EEM", "whu_Computational_Experiment", "whu_fellow", "whu_BioChemical_Experiment"),
    ("EEM", "whu_ResearchStep", "whu_declaredInput", "whu_DataSet"),
    ("EEM", "whu_ResearchStep", "whu_declaredUsed", "whu_Software"),
    ("MPU", "mp_References", "cito_isCitedBy", "whu_DataSet"),
    ("MPU", "mp_References", "cito_isCitedBy", "mp_Method"),
    ("MPU", "mp_References", "cito_isCitedBy", "mp_Claim"),
    ("MPU", "mp_References", "cito_isCitedBy", "mp_Statement"),
    ("EEM", "whu_Goal", "whu_hasTarget", "whu_TargetVariable"),
    ("EBM", "whu_ProcessedSpecimen", "prov_wasDerivedFrom", "whu_Specimen"),
    ("EEM", "whu_DataSet", "dcterms_hasPart", "iao_DataItem"),
    ("MPU", "whu_DataSet", "mp_challenges", "mp_Claim"),
    ("MPU", "whu_DataSet", "mp_supports", "mp_Claim"),
    ("MPU", "whu_DataSet", "mp_challenges", "mp_Statement"),
    ("MPU", "whu_DataSet", "mp_supports", "mp_Statement"),
    ("MPU", "mp_Statement", "mp_supports", "mp_Claim"),
    ("MPU", "mp_Statement", "mp_challenges", "mp_Claim"),
    ("MPU", "mp_Claim", "mp_supports", "mp_Claim"),
    ("MPU", "mp_Claim", "mp_challenges", "mp_Claim"),
    ("MPU", "whu_ScienceEvidence", "mp_supports", "whu_SupportGraph"),
    ("MPU", "whu_ScienceEvidence", "mp_challenges", "whu_SupportGraph"),
    ("EBM", "whu_EnvironmentFeature", "bfo_has_part", "envo_EnvironmentMaterial"),
    ("EBM", "whu_Specimen", "bfo_has_part", "whu_ChemicalEntity"),
    ("EBM", "obi_organism", "bfo_has_part", "whu_ChemicalEntity"),
    ("EBM", "envo_EnvironmentMaterial", "bfo_has_part", "whu_ChemicalEntity"),
    ("EBM", "whu_Specimen", "prov_wasDerivedFrom", "obi_organism"),
    ("EBM", "obi_organism", "prov_atLocation", "whu_EnvironmentFeature"),
    ("EBM", "whu_Specimen", "prov_wasDerivedFrom", "envo_EnvironmentMaterial"),
    ("EEM", "whu_TargetVariable", "iao_is_about", "whu_ChemicalEntity"),
    ("EEM", "whu_DataSet", "iao_is_about", "whu_TargetVariable"),
    ("EEM", "iao_DataItem", "iao_is_about", "whu_TargetVariable"),
    ("EEM", "iao_ScalarMeasurementDatum", "iao_is_about", "whu_TargetVariable"),
    ("EEM", "whu_ResearchStep", "whu_declaredOutput", "whu_Specimen"),
    ("EEM", "whu_ResearchStep", "whu_declaredInput", "whu_Specimen"),
    ("EEM", "whu_ResearchStep", "whu_declaredOutput", "whu_ProcessedSpecimen"),
    ("EEM", "whu_ResearchStep", "whu_declaredOutput", "whu_DataSet"),
    ("EEM", "whu_BioChemical_Experiment", "whu_fellow", "whu_BioChemical_Experiment"),
    ("EEM", "whu_Computational_Experiment", "whu_fellow", "whu_Computational_Experiment"),
    ("EBM", "whu_ResearchStep", "prov_atLocation", "whu_EnvironmentFeature"),
    ("EBM", "whu_SpecimenCollection", "whu_hasContext", "whu_EnvironmentFeature"),
    ("MPU", "mp_References", "mp_supports", "mp_Claim"),
    ("MPU", "mp_References", "mp_supports", "mp_Statement"),
    ("MPU", "whu_ScienceEvidence", "mp_supports", "mp_Claim"),
    ("MPU", "whu_ScienceEvidence", "mp_challenges", "mp_Claim"),
    ("EBM", "whu_Specimen", "p_plan_isInputVarOf", "whu_SpecimenPreprocessing"),
    ("EBM", "whu_Specimen", "p_plan_isOutputVarOf", "whu_SpecimenCollection"),
    ("EEM", "whu_ProcessedSpecimen", "p_plan_isInputVarOf", "whu_BioChemical_Experiment"),
    ("EBM", "whu_ProcessedSpecimen", "p_plan_isOutputVarOf", "whu_SpecimenPreprocessing"),
    ("EEM", "whu_DataSet", "p_plan_isOutputVarOf", "whu_Computational_Experiment"),
    ("EBM", "whu_Specimen", "prov_wasDerivedFrom", "whu_EnvironmentFeature"),
    ("EEM", "whu_DataSet", "iao_is_about", "whu_Reagent"),
    ("EEM", "whu_DataSet", "iao_is_about", "whu_Specimen"),
    ("EEM", "whu_DataSet", "iao_is_about", "whu_ProcessedSpecimen"),
    ("MPU", "whu_ScienceEvidence", "mp_supports", "mp_Statement"),
    ("MPU", "whu_ScienceEvidence", "mp_challenges", "mp_Statement"),
]

# Section role, structural type, prior view roles; and the aliases of roles.
_SECTIONS = [
    ("Abstract", "doco_Abstract", ["EBM", "EEM", "MPU"]),
    ("Introduction", "deo_Introduction", ["EBM", "MPU"]),
    ("Methods_Materials", "deo_Materials_and_Methods", ["EBM", "EEM"]),
    ("Results", "deo_Results", ["EBM", "EEM", "MPU"]),
    ("Discussion", "deo_Discussion", ["MPU"]),
    ("Conclusion", "deo_Conclusion", ["MPU"]),
    ("References", "doco_Bibliography", ["MPU"]),
    ("Other", None, []),
]
SECTION_ALIASES = {
    "abstract": "Abstract", "introduction": "Introduction", "methods": "Methods_Materials", "materials": "Methods_Materials", "methods_materials": "Methods_Materials", "results": "Results",
    "discussion": "Discussion", "conclusion": "Conclusion", "references": "References", "bibliography": "References", "other": "Other",
}

# The labels and relation types that each view's graph is projected from.
_PROJECTIONS = {
    "MPU": (
        [
            "mp_References", "whu_DataSet", "mp_Claim", "mp_Statement", "mp_Method", "mp_Attribution", "whu_ScienceEvidence", "whu_SupportGraph",
        ],
        [
            "mp_supports", "mp_challenges", "cito_isCitedBy", "prov_hadMember",
        ],
    ),
    "EBM": (
        [
            "whu_EnvironmentFeature", "envo_EnvironmentMaterial", "whu_SpecimenCollection", "whu_SpecimenPreprocessing", "whu_ResearchStep",
            "whu_Specimen", "whu_ProcessedSpecimen", "obi_organism", "whu_ChemicalEntity", "mp_Method", "whu_Device", "whu_Reagent", "whu_DataSet",
            "iao_DataItem", "iao_ScalarMeasurementDatum",
        ],
        [
            "whu_hasContext", "whu_fellow", "prov_wasDerivedFrom", "prov_atLocation", "whu_declaredUsed", "whu_declaredInput", "whu_declaredOutput",
            "p_plan_isPrecededBy", "p_plan_isInputVarOf", "p_plan_isOutputVarOf", "bfo_has_part", "dcterms_hasPart", "iao_is_about",
        ],
    ),
    "EEM": (
        [
            "whu_BioChemical_Experiment", "whu_Computational_Experiment", "whu_ResearchStep", "whu_Goal", "whu_TargetVariable", "whu_DataSet",
            "whu_ProcessedSpecimen", "whu_Specimen", "mp_Method", "whu_Device", "whu_Reagent", "whu_Software", "iao_DataItem",
            "iao_ScalarMeasurementDatum", "whu_ChemicalEntity",
        ],
        [
            "whu_fellow", "whu_hasGoal", "whu_hasTarget", "whu_declaredUsed", "whu_declaredInput", "whu_declaredOutput", "p_plan_isPrecededBy",
            "p_plan_isInputVarOf", "p_plan_isOutputVarOf", "iao_is_about", "dcterms_hasPart",
        ],
    ),
}

# Labels of plans and containers, and the properties that every entity has.
PLAN_LABELS = ["whu_SpecimenCollection", "whu_SpecimenPreprocessing", "whu_BioChemical_Experiment", "whu_Computational_Experiment"]
CONTAINER_LABELS = ["whu_ScienceEvidence", "whu_SupportGraph"]
_REQUIRED = {"WHU_HASNAME": "STRING", "WHU_HASORIGINALTEXT": "STRING"}


@dataclass(frozen=True)
class Ontology:
    """Plain rows: what may be extracted, and how the graph is looked at."""

    entities: dict[str, dict[str, str]]
    relations: list[str]
    triples: list[tuple[str, str, str, list[str], str]]
    paths: list[tuple[str, str, str, str]]
    views: dict[str, list[str]]
    sections: dict[str, tuple[str | None, list[str]]]
    projections: dict[str, tuple[list[str], list[str]]] = field(default_factory=dict)

    def frames(self, spark: SparkSession) -> dict[str, DataFrame]:
        """Each part as a small DataFrame; all have a size that the ontology fixes."""
        make = spark.createDataFrame
        return {
            "entity_def": make([(label, k, t) for label, ps in self.entities.items() for k, t in ps.items()], "label string, property string, type string"),
            "relation_def": make([(r,) for r in self.relations], "rel_type string"),
            "triple_template": make([(k, *t) for k, t in enumerate(self.triples, 1)], "template_id int, subject string, relation string, object string, sections array<string>, tier string"),
            "path_template": make(self.paths, "view string, subject string, relation string, object string"),
            "view_mapping": make([(VIEWS.index(v), v, label) for v, labels in self.views.items() for label in labels], "view_order int, view string, label string"),
            "section_prior": make([(r, t, roles) for r, (t, roles) in self.sections.items()], "section_role string, structural_type string, roles array<string>"),
            "view_projection_node": make([(v, label) for v, (labels, _) in self.projections.items() for label in labels], "view string, label string"),
            "view_projection_rel": make([(v, r, "NATURAL") for v, (_, rels) in self.projections.items() for r in rels], "view string, rel_type string, orientation string"),
        }


def default_ontology() -> Ontology:
    return Ontology(
        entities={label: _REQUIRED | own for label, _, own in _ENTITIES},
        relations=list(_RELATIONS),
        triples=[(*t[:3], list(t[3]), t[4]) for t in _TRIPLES],
        paths=list(_PATHS),
        views={view: [label for label, views, _ in _ENTITIES if view in views] for view in VIEWS},
        sections={role: (kind, list(roles)) for role, kind, roles in _SECTIONS},
        projections={view: (list(labels), list(types)) for view, (labels, types) in _PROJECTIONS.items()},
    )


def problems(ontology: Ontology) -> dict[str, list[str]]:
    """What is wrong, as {"errors": [...], "warnings": [...]}."""
    errors, warnings = [], []
    known, types = set(ontology.entities), set(ontology.relations)
    if not known:
        errors.append("no entity is defined")
    for a, r, b, *_ in ontology.triples:
        errors += [f"triple ({a}, {r}, {b}): {x} is not defined" for x, where in ((a, known), (b, known), (r, types)) if x not in where]
    if sorted(ontology.views) != sorted(VIEWS):
        errors.append(f"views are {sorted(ontology.views)}, not {sorted(VIEWS)}")
    for view, labels in ontology.views.items():
        if not labels:
            errors.append(f"view {view} has no labels")
        errors += [f"view {view} has {x} twice" for x in sorted({x for x in labels if labels.count(x) > 1})]
    covered = {x for labels in ontology.views.values() for x in labels}
    errors += [f"label {x} is in no view" for x in sorted(known - covered)] + [f"view label {x} is not defined" for x in sorted(covered - known)]
    own = {t[:3] for t in ontology.triples}
    warnings += [f"path template {p} has no triple" for p in ontology.paths if p[1:] not in own]
    for view, (labels, rels) in ontology.projections.items():
        errors += [f"projection {view}: {x} is not defined" for x in [*labels, *rels] if x not in known | types]
    if "Other" not in ontology.sections:
        errors.append("section priors have no Other")
    return {"errors": errors, "warnings": warnings}
