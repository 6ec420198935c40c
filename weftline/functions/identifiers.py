"""Identifiers: their parts, the vocabularies they belong to, and the strings that only stand in their place.

Rules are tables of patterns, applied by one expression each, so a rule more is a line more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalars import col

# How identifiers part into a prefix and a local name; the first pattern that fits counts. A local name
# may hold a colon only in an address.
PART_PATTERNS = [
    r"^()(http[^:]*:[^:]*)$",
    r"^([^:]*):([^:]*)$",
    r"^(SNOMED|CLO|ENVO|CHR|HPS|CVCL|BFO)_([^:]*)$",
    r"^()([^:]*)$",
]

# Names of properties that hold identifiers.
ID_PROPERTY = r"^(?:snomedct|icd10|icd9|accession|(?=.*(?:id|_list))(?:chembl|drugbank|chebi|pubchem|kegg|mesh|ensembl|omim)(?:_.*)?)$"

# What is no identifier of a vocabulary, as patterns; "" stands for any vocabulary.
INVALID_PATTERNS = {
    "": r"^\s*[-–—]\s*$",
    "chebi": r"^root$",
    "clo": r"^http://",
    "dbsnp": r",",
    "metacyc.pathway": r"\p{Ll}|^\P{Lu}*$",
    "react": r"^root$",
    "snomedct": r"e\+",
}

# The prefixes whose identifiers are checked against a vocabulary's rules, and the vocabularies that a
# prefix may mean, in the order in which they are tried.
GATED = ["CHEMBL.COMPOUND", "CHEMBL.TARGET", "UNII", "KEGG"]
MEANT = {"kegg": ["kegg", "kegg.compound", "kegg.target"]}

#: By vocabulary: the prefix of its CURIEs and the pattern of its local names.
Rules = dict[str, tuple[str, str]]


def id_parts(c: str | Column) -> Column:
    """Prefix and local part of an identifier; no prefix is "". Null for one that no pattern fits."""
    c = col(c)
    out = None
    for p in PART_PATTERNS:
        parts = F.struct(F.trim(F.regexp_extract(c, p, 1)).alias("prefix"), F.trim(F.regexp_extract(c, p, 2)).alias("local"))
        out = F.when(F.rlike(c, F.lit(p)), parts) if out is None else out.when(F.rlike(c, F.lit(p)), parts)
    return out


def is_id_property(name: str | Column) -> Column:
    return F.rlike(F.lower(col(name)), F.lit(ID_PROPERTY))


def known_invalid(local: Column, vocabularies: Column) -> Column:
    """Whether a string is no identifier in one of the vocabularies, given as a list or as one name."""
    patterns = F.create_map(*[F.lit(x) for kv in INVALID_PATTERNS.items() for x in kv])
    of = F.concat(F.array(F.lit("")), F.coalesce(vocabularies, F.array().cast("array<string>")))
    return F.exists(of, lambda v: F.coalesce(F.rlike(local, F.try_element_at(patterns, v)), F.lit(False)))


def curie_of(vocabularies: Column, local: Column, rules: Rules | None = None) -> Column:
    """The CURIE of a local name in the first vocabulary whose rule it fits; null if there is none.

    Without rules, that is the first vocabulary, in upper case.
    """
    if rules is None:
        return F.concat(F.upper(F.get(vocabularies, F.lit(0))), F.lit(":"), local)
    table = F.create_map(*[x for v, (p, pattern) in rules.items() for x in (F.lit(v), F.struct(F.lit(p).alias("prefix"), F.lit(pattern).alias("pattern")))])
    fits = F.transform(vocabularies, lambda v: F.when(F.rlike(local, F.try_element_at(table, v)["pattern"]), F.concat(F.try_element_at(table, v)["prefix"], F.lit(":"), local)))
    return F.get(F.filter(fits, lambda x: x.isNotNull()), F.lit(0))


def gated_curie(c: str | Column, rules: Rules) -> Column:
    """struct(curie, gated, valid): an identifier under a gated prefix by the rules of what it may mean.

    One that no rule fits stays as it is and is not valid; all others stay and are valid.
    """
    c = col(c)
    parts = F.split(c, ":")
    name, local = F.lower(F.get(parts, F.lit(0))), F.get(parts, F.lit(1))
    gated = F.contains(c, F.lit(":")) & F.upper(F.get(parts, F.lit(0))).isin(GATED)
    meant = F.create_map(*[x for k, vs in MEANT.items() for x in (F.lit(k), F.array(*map(F.lit, vs)))])
    found = F.when(gated & (F.size(parts) == 2), curie_of(F.coalesce(F.try_element_at(meant, name), F.array(name)), local, rules))
    return F.struct(F.coalesce(found, c).alias("curie"), F.coalesce(gated, F.lit(False)).alias("gated"), (~gated | found.isNotNull()).alias("valid"))


def invalid_counts(df: DataFrame, c: str | Column, rules: Rules) -> DataFrame:
    """(vocabulary, known, n): identifiers under gated prefixes that no rule fits; known: whether it has rules at all."""
    bad = df.select(gated_curie(c, rules).alias("g")).where("g.gated AND NOT g.valid").select(F.lower(F.substring_index("g.curie", ":", 1)).alias("vocabulary"))
    named = F.create_map(*[F.lit(x) for v in {*rules, *(k for k, vs in MEANT.items() if set(vs) & set(rules))} for x in (v, True)]) if rules else None
    known = F.coalesce(F.try_element_at(named, F.col("vocabulary")), F.lit(False)) if rules else F.lit(False)
    return bad.groupBy("vocabulary").agg(F.count("*").alias("n")).select("vocabulary", known.alias("known"), "n")
