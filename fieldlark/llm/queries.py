"""The registered queries of this subpackage, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from . import collocations, decontaminate, knn, mixing, quality_rules, variants, warc
from .collocations import op13_collocations
from .decontaminate import op10_contained_items
from .extract import op2_main_text
from .jaccard_join import op3_jaccard_components
from .knn import op4_voronoi_knn
from .language import op5_language_id
from .licenses import op6_license_scan
from .mixing import op8_mix_sources
from .quality import op9_quality_discriminant
from .quality_rules import op11_quality_rules
from .toxicity import op7_toxicity_svm
from .variants import op12_spelling_variants
from .warc import op1_warc_transactions

QUERIES = {
    "op1_warc_transactions": op1_warc_transactions,
    "op2_main_text": op2_main_text,
    "op3_jaccard_components": op3_jaccard_components,
    "op4_voronoi_knn": op4_voronoi_knn,
    "op5_language_id": op5_language_id,
    "op6_license_scan": op6_license_scan,
    "op7_toxicity_svm": op7_toxicity_svm,
    "op8_mix_sources": op8_mix_sources,
    "op9_quality_discriminant": op9_quality_discriminant,
    "op10_contained_items": op10_contained_items,
    "op11_quality_rules": op11_quality_rules,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_collocations": op13_collocations,
}

ORACLE_SQL = {
    "op1_warc_transactions": warc.ORACLE_SQL,
    "op4_voronoi_knn": knn.ORACLE_SQL,
    "op8_mix_sources": mixing.ORACLE_SQL,
    "op10_contained_items": decontaminate.ORACLE_SQL,
    "op11_quality_rules": quality_rules.ORACLE_SQL,
    "op12_spelling_variants": variants.ORACLE_SQL,
    "op13_collocations": collocations.ORACLE_SQL,
}
