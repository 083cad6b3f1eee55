"""Entity types: canonical names, label aliases and what each annotator can produce."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .identifiers import lookup
from .text import col

#: The clinical label family shared by two taggers.  Two labels have canonical types.
CLINICAL_LABELS = (
    "DISEASE_DISORDER", "MEDICATION", "ACTIVITY", "ADMINISTRATION", "AGE", "AREA", "BIOLOGICAL_ATTRIBUTE",
    "BIOLOGICAL_STRUCTURE", "CLINICAL_EVENT", "COLOR", "COREFERENCE", "DATE", "DETAILED_DESCRIPTION", "DIAGNOSTIC_PROCEDURE",
    "DISTANCE", "DOSAGE", "DURATION", "FAMILY_HISTORY", "FREQUENCY", "HEIGHT", "HISTORY", "LAB_VALUE", "MASS",
    "NONBIOLOGICAL_LOCATION", "OCCUPATION", "OTHER_ENTITY", "OTHER_EVENT", "OUTCOME", "PERSONAL_BACKGROUND",
    "QUALITATIVE_CONCEPT", "QUANTITATIVE_CONCEPT", "SEVERITY", "SEX", "SHAPE", "SIGN_SYMPTOM", "SUBJECT", "TEXTURE",
    "THERAPEUTIC_PROCEDURE", "TIME", "VOLUME", "WEIGHT",
)
CLINICAL_TYPES = {"DISEASE_DISORDER": "disease", "MEDICATION": "drug"}

#: Annotator, its display name, and its (source type, canonical type, databases).
_BASIC = [("Gene / protein", "gene"), ("Disease", "disease"), ("Chemical / drug", "drug")]
_CANCER_GENETICS = [
    ("Amino acid", "amino_acid"), ("Anatomical system", "anatomical_system"), ("Cancer", "cancer"), ("Cell", "cell"), ("Cellular component", "cellular_component"),
    ("Developing anatomical structure", "developing_anatomical_structure"), ("Gene or gene product", "gene"), ("Immaterial anatomical entity", "immaterial_anatomical_entity"),
    ("Multi-tissue structure", "multi_tissue_structure"), ("Organ", "organ"), ("Organism", "species"), ("Organism subdivision", "organism_subdivision"),
    ("Organism substance", "organism_substance"), ("Pathological formation", "pathological_formation"), ("Simple chemical", "drug"), ("Tissue", "tissue"),
]
_CLINICAL = [(x.replace("_", " "), CLINICAL_TYPES.get(x, x.lower())) for x in CLINICAL_LABELS]
ANNOTATORS: dict[str, tuple[str, list[tuple]]] = {
    "pubtator3": ("PubTator3", [("Gene / protein", "gene", "NCBI Gene"), ("Disease", "disease", "MeSH"), ("Chemical / drug", "drug", "MeSH"), ("Species", "species", "NCBI Taxonomy"), ("Variant / mutation", "variant", "dbSNP", "ClinGen Allele Registry"), ("Cell line", "cell_line", "Cellosaurus")]),
    "bern2": ("BERN2", [("Gene / protein", "gene", "NCBI Gene"), ("Disease", "disease", "MeSH"), ("Drug", "drug", "DrugBank"), ("Species", "species", "NCBI Taxonomy"), ("Mutation / variant", "variant", "dbSNP"), ("Cell line", "cell_line", "Cellosaurus"), ("Cell type", "cell_type", "Cell Ontology"), ("DNA", "dna"), ("RNA", "rna")]),
    "flair": ("Flair / HunFlair", [*_BASIC, ("Species", "species"), ("Cell line", "cell_line")]),
    "aioner": ("AIONER", [("Gene", "gene"), ("Chemical", "drug"), ("Disease", "disease"), ("Species", "species"), ("Variant", "variant"), ("CellLine", "cell_line")]),
    "biobert": ("BioBERT", _BASIC),
    "clinicalbert": ("ClinicalBERT", [("problem", "problem"), ("test", "test"), ("treatment", "treatment")]),
    "apollo": ("Clinical-AI-Apollo Medical-NER", _CLINICAL),
    "d4data": ("d4data biomedical-ner-all", _CLINICAL),
    "medcat": ("MedCAT", []),
    "scispacy_jnlpba": ("scispaCy en_ner_jnlpba_md", [("DNA", "dna"), ("CELL_TYPE", "cell_type"), ("CELL_LINE", "cell_line"), ("RNA", "rna"), ("PROTEIN", "gene")]),
    "scispacy_bc5cdr": ("scispaCy en_ner_bc5cdr_md", [("DISEASE", "disease"), ("CHEMICAL", "drug")]),
    "scispacy_bionlp13cg": ("scispaCy en_ner_bionlp13cg_md", [(s.upper().replace(" ", "_"), c) for s, c in _CANCER_GENETICS]),
    "scispacy_craft": ("scispaCy en_ner_craft_md", [("GGP", "gene"), ("CHEBI", "drug"), ("CL", "cell_type"), ("TAXON", "species"), ("GO", "gene_ontology"), ("SO", "sequence_ontology")]),
    "scispacy_scibert": ("scispaCy en_core_sci_scibert", [("ENTITY", "biomedical_entity", "UMLS")]),
    "scispacy_md": ("scispaCy en_core_sci_md", [("ENTITY", "biomedical_entity", "UMLS")]),
    "bent": ("BENT", [("disease", "disease", "MEDIC", "Disease Ontology"), ("chemical", "drug", "ChEBI", "CTD Chemicals"), ("gene", "gene", "NCBI Gene", "CTD Gene"), ("organism", "species", "NCBI Taxonomy"), ("bioprocess", "bioprocess", "Gene Ontology Biological Process"), ("anatomical", "anatomical", "CTD Anatomy", "UBERON", "FMA"), ("anatomy", "anatomical", "CTD Anatomy", "UBERON", "FMA"), ("cell_component", "cell_component", "Gene Ontology Cellular Component"), ("cell_type", "cell_type", "Cell Ontology"), ("cell_line", "cell_line", "Cellosaurus"), ("variant", "variant")]),
    "stanza_bc5cdr": ("Stanza BC5CDR", [("Chemical", "drug"), ("Disease", "disease")]),
    "stanza_bionlp13cg": ("Stanza BioNLP13CG", _CANCER_GENETICS),
    "stanza_jnlpba": ("Stanza JNLPBA", [("Protein", "gene"), ("DNA", "dna"), ("RNA", "rna"), ("Cell line", "cell_line"), ("Cell type", "cell_type")]),
    "stanza_i2b2": ("Stanza i2b2", [("Problem", "problem"), ("Test", "test"), ("Treatment", "treatment")]),
    "stanza_radiology": ("Stanza radiology", [("Anatomy", "anatomical"), ("Anatomy modifier", "anatomy_modifier"), ("Observation", "observation"), ("Observation modifier", "observation_modifier"), ("Uncertainty", "uncertainty")]),
    "stanza_anatem": ("Stanza AnatEM", [("Anatomy", "anatomical")]),
}
#: Annotators that normalise their spans, and the payload fields that carry identifiers.
NORMALIZING = {
    "pubtator3": ("BioC infons.identifier", "annotation.identifier", "annotation.id", "PubAnnotation denotations[].obj suffix", "PubTator text column 6"),
    "bern2": ("id", "db_id", "identifier", "normalizedName"),
    "medcat": ("cui",),
    "scispacy_scibert": ("EntityLinker kb_ents", "UMLS CUI"),
    "scispacy_md": ("EntityLinker kb_ents", "UMLS CUI"),
    "bent": ("BRAT N Reference lines",),
}
#: Canonical types that reports show, in order; the first group is offered as a choice.
CHOICES = ("gene", "disease", "drug", "species", "variant", "cell_line", "cell_type", "dna", "rna", "biomedical_entity", "bioprocess", "anatomical", "cell_component")
DISPLAY_TYPES = (*CHOICES[:10], "cell", "cancer", "amino_acid", "anatomical_system", "cellular_component", "developing_anatomical_structure", "immaterial_anatomical_entity", "multi_tissue_structure", "organ", "organism_subdivision", "organism_substance", "pathological_formation", "tissue", *CHOICES[10:])
#: Further labels.
_MORE_LABELS = {"cellline": "cell_line", "cell_line": "cell_line", "celltype": "cell_type", "cell_type": "cell_type", "chemical": "drug", "drug": "drug", "gene": "gene", "protein": "gene", "mutation": "variant", "variant": "variant", "dna": "dna", "rna": "rna"}


def _key(label: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", label.strip().lower()).strip("_")


LABELS = {_key(t[0]): t[1] for _, types in ANNOTATORS.values() for t in types} | {t: t for t in DISPLAY_TYPES} | _MORE_LABELS


def normalize_entity_type(x: Column | str) -> Column:
    """Canonical type of a label; unmapped labels pass through as their key, blanks are unknown."""
    key = F.trim(F.regexp_replace(F.lower(col(x).cast("string")), "[^a-z0-9]+", "_"), F.lit("_"))  # white space at the ends goes with the signs
    return F.coalesce(lookup(LABELS | {"": "unknown"}, key), key, F.lit("unknown"))


def entity_type_specs(spark: SparkSession) -> DataFrame:
    """The capability dimension: one row per annotator and source type (fixed size)."""
    rows = [(a, name, t[0], t[1], list(t[2:])) for a, (name, types) in ANNOTATORS.items() for t in types]
    return spark.createDataFrame(rows, "annotator string, annotator_label string, source_entity_type string, canonical_entity_type string, database_ids array<string>")


def annotator_capabilities(spark: SparkSession) -> DataFrame:
    """One row per annotator: its tasks, normalization status and identifier fields."""
    rows = [(a, name, ["NER", "NEN"] if a in NORMALIZING else ["NER"], "normalized" if a in NORMALIZING else "not_returned", list(NORMALIZING.get(a, ()))) for a, (name, _) in ANNOTATORS.items()]
    return spark.createDataFrame(rows, "annotator string, annotator_label string, tasks array<string>, normalization_status string, normalization_fields array<string>")


def normalization_databases(requests: DataFrame) -> DataFrame:
    """requests(entity_type, annotator) + databases: what the annotator links that type to; empty when the
    type is not a display type or the annotator is unknown."""
    specs = entity_type_specs(requests.sparkSession).select(F.col("annotator"), F.col("canonical_entity_type").alias("_type"), F.col("database_ids")).dropDuplicates(["annotator", "_type"])
    asked = requests.withColumn("_type", normalize_entity_type("entity_type"))
    joined = asked.join(F.broadcast(specs), ["annotator", "_type"], "left")
    found = F.when(F.col("_type").isin(*DISPLAY_TYPES), F.col("database_ids"))
    return joined.withColumn("databases", F.coalesce(found, F.array().cast("array<string>"))).drop("_type", "database_ids")


def type_choices(annotators: list[str]) -> list[str]:
    """Types that a set of annotators can produce: canonical order first, then the others by name."""
    have = {t[1] for a in annotators for t in ANNOTATORS.get(a, ("", []))[1]}
    return [t for t in CHOICES if t in have] + sorted(have - set(CHOICES))


def type_choices_of(requests: DataFrame, key: str) -> DataFrame:
    """requests(key, annotator) -> key, choices: the types that the annotators of a key can produce, in the
    order of ``type_choices``; unknown annotators add none."""
    specs = entity_type_specs(requests.sparkSession).select("annotator", F.col("canonical_entity_type").alias("_type")).distinct()
    place = F.array_position(F.array(*map(F.lit, CHOICES)), F.col("_type"))
    found = requests.select(key, "annotator").distinct().join(specs, "annotator", "left")
    types = found.groupBy(key).agg(F.array_sort(F.collect_set(F.when(F.col("_type").isNotNull(), F.struct((place == 0).alias("extra"), place.alias("place"), "_type")))).alias("x"))
    return types.select(key, F.transform("x", lambda x: x["_type"]).alias("choices"))


def unsupported_types(requests: DataFrame) -> DataFrame:
    """requests(annotator, entity_type) that the annotator cannot produce."""
    specs = entity_type_specs(requests.sparkSession).select("annotator", F.col("canonical_entity_type").alias("_type")).distinct()
    asked = requests.withColumn("_type", normalize_entity_type("entity_type"))
    return asked.join(F.broadcast(specs), ["annotator", "_type"], "left_anti").drop("_type")
