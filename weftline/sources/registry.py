"""The sources of the graph: a specification where columns say it all, else the plan that builds it."""

from __future__ import annotations

from ..plans import biomedical, mixed_graph
from .spec import SourceSpec

# Names of columns, sources and vocabulary in the declarative sources.
UNRELIABLE = ("infores:hmdb",)
SPECS = {
    "kg2": SourceSpec(
        "rtx-kg2", category="all_categories", equivalents="equivalent_curies", synonyms=("all_names",), url="iri", ignored=("publications",), ignored_edges=("domain_range_exclusion",),
        formula="chemical_formula", mass="exact_mass", unreliable=UNRELIABLE,
        renamed={"category": "canonical_category", "id": "kg2c_ids", "kg2_ids": "kg2pre_ids", "qualified_object_direction": "object_direction_qualifier", "qualified_object_aspect": "object_aspect_qualifier"},
        predicate_overrides={"biolink:drug_regulatory_status_world_wide": "biolink:treats_or_applied_or_studied_to_treat"},
    ),
    "robokop": SourceSpec(
        "robokop-kg", equivalents="equivalent_identifiers", url="url", formula="chemical_formula", mass="exact_mass", publications_info="sentences", excluded_primaries=("infores:ubergraph",), unreliable=UNRELIABLE,
    ),
    "molepro": SourceSpec(
        "molepro", delimiter="|", whole=("name",), equivalents="xref", synonyms=("synonym", "trade_name", "symbol"), url="url", formula="has_chemical_formula", mass="exact_mass", ignored=("attributes",),
        ignored_edges=("attributes", "aggregator_knowledge_source"), unreliable=UNRELIABLE,
        category_overrides={
            "biolink:ProteinComplex": "biolink:MacromolecularComplex",
            "biolink:MacromolecularComplexMixin": "biolink:MacromolecularComplex",
            "biolink:PairwiseGeneToGeneInteraction": "biolink:MacromolecularComplex",
            "biolink:Organism": "biolink:OrganismTaxon",
        },
        predicate_overrides={
            "biolink:is_active_metabolite_of": "biolink:is_metabolite_of",
            "biolink:has_active_metabolite": "biolink:has_metabolite",
            "biolink:has_variant": "biolink:related_to_at_concept_level",
            "biolink:is_variant_of": "biolink:related_to_at_concept_level",
        },
        agent_overrides={
            ("experimental_agent", "infores:chembl"): "manual_agent",
            ("experimental_agent", "infores:bindingdb"): "not_provided",
            ("experimental_agent", "infores:ki-database"): "not_provided",
            ("experimental_agent", "infores:kinomescan"): "not_provided",
            ("experimental_agent", "infores:pubchem"): "not_provided",
            ("experimental_agent", "infores:community-sar"): "not_provided",
            ("experimental_agent", "infores:drug-design"): "not_provided",
            ("manual_validation_of_experimental_agent", "infores:chembl"): "manual_agent",
        },
    ),
    "microbiome-kg": SourceSpec(
        "multiomics-microbiome", aggregates=False, formula="chemical_formula", mass="exact_mass", edge_publications="publication", default_primary="infores:multiomics-microbiome",
        default_supporting=("infores:pubmed-central",), unreliable=UNRELIABLE,
    ),
    "multiomics-kg": SourceSpec(
        "multiomics-multiomics", aggregates=False, formula="chemical_formula", mass="exact_mass", edge_publications="publication", default_primary="infores:multiomics-multiomics",
        default_supporting=("infores:pubmed-central",), unreliable=UNRELIABLE,
    ),
    "translator-kg-open": SourceSpec(
        "translator-kg-open", source="translator-kg-open", synonyms=("synonym",), taxa=("taxon", "in_taxon"), url="iri", formula="chemical_formula", mass="exact_mass", unreliable=UNRELIABLE,
        predicate_overrides={"biolink:involved_in": "biolink:actively_involved_in"},
    ),
}

#: Sources whose graph is a plan of its own, over the tables that the readers give.
PLANS = {
    "spoke": mixed_graph.mixed_graph,
    "umls": biomedical.part_links,
    "lipidmaps": biomedical.molecules,
    "loinc": biomedical.scale_category,
    "refmet": biomedical.molecules,
    "clingen": biomedical.actionable,
    "cdes": biomedical.data_element_edges,
    "pgs-catalog": biomedical.score_graph,
    "bio-bmi": biomedical.correlates,
    "bio-age": biomedical.correlates,
}
NAMES = ["kg2", "robokop", "molepro", "microbiome-kg", "multiomics-kg", "spoke", "umls", "lipidmaps", "loinc", "refmet", "clingen", "cdes", "translator-kg-open", "pgs-catalog", "bio-bmi", "bio-age"]
