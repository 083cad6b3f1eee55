"""Identifiers: publication ids, concept ids, their aliases, display forms and links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, strip, strip_quick

#: Database prefixes that mean the same database when identifiers are compared.
DATABASE_ALIASES = {"MSH": "MESH", "ME": "MESH", "MIM": "OMIM"}
#: Display casing of identifier prefixes.
DISPLAY_PREFIX = {
    "mesh": "MESH", "ncbigene": "NCBIGene", "ncbi_gene": "NCBIGene", "ncbi-gene": "NCBIGene", "ncbitaxon": "NCBITaxon", "ncbitaxonomy": "NCBITaxon",
    "ncbi_taxonomy": "NCBITaxon", "taxonomy": "NCBITaxon", "taxon": "NCBITaxon", "dbsnp": "dbSNP", "chebi": "CHEBI", "drugbank": "DrugBank",
    "cellosaurus": "CVCL", "cvcl": "CVCL", "omim": "OMIM", "mim": "OMIM", "cl": "CL", "go": "GO", "doid": "DOID", "uberon": "UBERON", "bto": "BTO", "fma": "FMA", "pato": "PATO",
}
#: Public pages of identifiers; the part after the colon is appended.
LINK_BASE = {
    "mesh": "https://meshb.nlm.nih.gov/record/ui?ui=", "ncbigene": "https://www.ncbi.nlm.nih.gov/gene/", "ncbi_gene": "https://www.ncbi.nlm.nih.gov/gene/",
    "ncbi-gene": "https://www.ncbi.nlm.nih.gov/gene/", "ncbitaxon": "https://www.ncbi.nlm.nih.gov/taxonomy/", "ncbitaxonomy": "https://www.ncbi.nlm.nih.gov/taxonomy/",
    "ncbi_taxonomy": "https://www.ncbi.nlm.nih.gov/taxonomy/", "ncbi-taxonomy": "https://www.ncbi.nlm.nih.gov/taxonomy/", "taxonomy": "https://www.ncbi.nlm.nih.gov/taxonomy/",
    "taxon": "https://www.ncbi.nlm.nih.gov/taxonomy/", "dbsnp": "https://www.ncbi.nlm.nih.gov/snp/", "rs": "https://www.ncbi.nlm.nih.gov/snp/",
    "chebi": "https://www.ebi.ac.uk/chebi/searchId.do?chebiId=CHEBI:", "drugbank": "https://go.drugbank.com/drugs/", "omim": "https://www.omim.org/entry/", "mim": "https://www.omim.org/entry/",
}
CELL_LINE_BASE, OBO_BASE = "https://www.cellosaurus.org/", "https://purl.obolibrary.org/obo/"
OBO_PREFIXES = ("cl", "go", "doid", "uberon", "bto", "fma", "pato")
BARE_NUMBER = {"gene": ("NCBIGene:", LINK_BASE["ncbigene"]), "species": ("NCBITaxon:", LINK_BASE["taxon"])}
#: Values that annotators give for "no concept found".
NO_CONCEPT = ("cui-less", "-", "")


def lookup(table: dict[str, str], key: Column) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), key)


def normalize_pmid(x: Column | str) -> Column:
    """Without white space and a PMID: prefix; blank becomes null."""
    return F.nullif(strip(F.regexp_replace(strip(x), r"(?i)^PMID:", "")), F.lit(""))


def normalize_pmcid(x: Column | str) -> Column:
    """PMC and digits; null where the input is not such an id."""
    bare = F.regexp_replace(F.regexp_replace(F.upper(strip(x)), "^PMC:", ""), "^(?!PMC)", "PMC")
    return F.when(F.rlike(bare, F.lit(r"^PMC\d+$")), bare)


def real_identifier(x: Column | str) -> Column:
    """The identifier, or null if it stands for no concept."""
    return F.when(~F.lower(strip(x)).isin(*NO_CONCEPT), col(x))


def sanitize(x: Column | str) -> Column:
    text = strip_quick(x) if isinstance(x, str) else strip(x.cast("string"))
    return F.when(~text.isin("", "-"), text)


def identifier_values(x: Column | str) -> Column:
    """A value or a stringified list of values as an array of strings; null becomes an empty array."""
    text = strip_quick(x) if isinstance(x, str) else strip(x)
    listed = text.startswith("[") & text.endswith("]")  # only these are parsed
    parsed = F.when(listed, F.filter(F.from_json(text, "array<string>", {"allowSingleQuotes": "true"}), lambda v: v.isNotNull()))
    return F.when(text.isNull(), F.array().cast("array<string>")).otherwise(F.coalesce(parsed, F.array(col(x))))


def normalize_mesh(v: Column) -> Column:
    return F.regexp_replace(strip(v), "(?i)^mesh:", "MESH:")


def normalized_identifiers(x: Column | str) -> Column:
    """Flattened values, with one casing of the MeSH prefix."""
    return F.transform(identifier_values(x), normalize_mesh)


def joined_identifiers(x: Column | str) -> Column:
    return F.array_join(normalized_identifiers(x), "|")


def _once(x: Column, of) -> Column:
    """of(x), with x worked out a single time for a value inside a list (there nothing else is shared)."""
    return F.get(F.transform(F.array(x), of), F.lit(0))


def _after_colon(x: Column) -> Column:
    return F.substr(x, F.instr(x, ":") + 1)


def _canonical(v: Column) -> Column:
    def of(text):
        prefix = F.substring_index(text, ":", 1)
        known = F.when(prefix.isin(*DATABASE_ALIASES), lookup(DATABASE_ALIASES, prefix)).otherwise(prefix)
        return F.when(~text.contains(":"), text).when(F.endswith(text, F.lit(":")) & (F.instr(text, ":") == F.length(text)), known).otherwise(F.concat(known, F.lit(":"), _after_colon(text)))

    return _once(F.replace(F.upper(v), F.lit(" "), F.lit("")), of)


def _bare(v: Column) -> Column:
    return F.regexp_replace(strip(v), "^['\"]+|['\"]+$", "")


def value_aliases(v: Column) -> Column:
    """Comparable forms of one identifier: the full one and what follows its colon."""
    none = F.array().cast("array<string>")
    aliases = lambda full: F.when(full == "", none).when(full.contains(":") & (F.instr(full, ":") < F.length(full)), F.array(full, _after_colon(full))).otherwise(F.array(full))
    return _once(_bare(v), lambda bare: F.when(bare.isNull() | bare.isin("", "-"), none).otherwise(_once(_canonical(bare), aliases)))


def _split_values(x: Column) -> Column:
    text = strip(x)
    parsed = F.from_json(text, "array<string>", {"allowSingleQuotes": "true"})
    listed = F.rlike(text, F.lit(r"(?s)^\[.*\]$")) & parsed.isNotNull()
    pieces = F.split(F.regexp_replace(text, r"^[\[\]]+|[\[\]]+$", ""), "[;,|]")
    pieces = F.filter(F.transform(pieces, lambda p: _bare(p)), lambda p: p != "")
    return F.when(text.isNull() | (text == ""), F.array().cast("array<string>")).when(listed, F.filter(parsed, lambda v: v.isNotNull() & (v != ""))).otherwise(pieces)


def _plain(x: Column) -> Column:
    """Whether it is one value of letters and digits around a colon, as most identifiers are: nothing is stripped,
    split or parsed then."""
    return F.rlike(x, F.lit(r"\A[A-Za-z0-9]+:[A-Za-z0-9]+\z"))


def _plain_aliases(x: Column) -> Column:
    """value_aliases of such a value, without the lists and regular expressions that take ten times as long."""
    prefix, rest = F.substring_index(F.upper(x), ":", 1), F.substring_index(F.upper(x), ":", -1)
    known = prefix
    for other, name in DATABASE_ALIASES.items():
        known = F.when(prefix == other, name).otherwise(known)
    return F.array(F.concat(known, F.lit(":"), rest), rest)


def prediction_aliases(x: Column | str) -> Column:
    """Alias set of a prediction's identifier: a value, a separated or a stringified list."""
    return F.when(_plain(col(x)), _plain_aliases(col(x))).otherwise(F.array_distinct(F.flatten(F.transform(_split_values(col(x)), value_aliases))))


def gold_value_aliases(x: Column | str) -> Column:
    """One alias array for each identifier of a gold span."""
    values = F.flatten(F.transform(col(x), lambda v: F.when(_plain(v), F.array(v)).otherwise(_split_values(v))))
    return F.filter(F.transform(values, lambda v: F.when(_plain(v), _plain_aliases(v)).otherwise(value_aliases(v))), lambda a: F.size(a) > 0)


def format_identifier(x: Column | str, entity_type: Column | str) -> Column:
    """One casing per prefix; bare gene and species numbers gain theirs."""
    raw = strip(x)
    prefix = F.substring_index(raw, ":", 1)
    known = lookup(DISPLAY_PREFIX, F.lower(prefix))
    digits = F.rlike(raw, F.lit(r"^\d+$"))
    bare = F.when(digits & (col(entity_type) == "gene"), F.concat(F.lit("NCBIGene:"), raw)).when(digits & (col(entity_type) == "species"), F.concat(F.lit("NCBITaxon:"), raw)).otherwise(raw)
    return F.coalesce(F.when(~raw.contains(":"), bare).when(known.isNotNull(), F.concat(known, F.substr(raw, F.length(prefix) + 1))).otherwise(raw), F.lit(""))


def database_link(x: Column | str, entity_type: Column | str) -> Column:
    """Public page of an identifier; null if its database is not known."""
    raw = F.nullif(strip(x), F.lit(""))
    prefix = F.lower(F.substring_index(raw, ":", 1))
    rest = F.substr(raw, F.length(prefix) + 2)
    cell = F.when(rest.startswith("CVCL_"), rest).otherwise(F.concat(F.lit("CVCL_"), rest))
    digits = F.rlike(raw, F.lit(r"^\d+$"))
    out = F.when(raw.contains(":"), F.coalesce(F.concat(lookup(LINK_BASE, prefix), rest), F.when(prefix.isin("cvcl", "cellosaurus"), F.concat(F.lit(CELL_LINE_BASE), cell)), F.when(prefix.isin(*OBO_PREFIXES), F.concat(F.lit(OBO_BASE), F.upper(prefix), F.lit("_"), rest))))
    for kind, (_, base) in BARE_NUMBER.items():
        out = out.when(digits & (col(entity_type) == kind), F.concat(F.lit(base), raw))
    return out
