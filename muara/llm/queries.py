"""The subpackage's registered queries, each over the whole of its table."""

from __future__ import annotations

import corpus_pipeline
from muara.llm.cascade import op5_quality_rules
from muara.llm.debruijn import op6_substring_dedup
from muara.llm.decontaminate import op9_decontaminate
from muara.llm.licenses import op7_license_scan
from muara.llm.packing import op4_best_fit_packing
from muara.llm.pseudonyms import op2_pseudonyms
from muara.llm.resampling import op12_resampling
from muara.llm.secret_scan import op10_secret_scan
from muara.llm.simhash import op3_simhash
from muara.llm.suffix_dedup import op1_suffix_dedup
from muara.llm.token_counts import op8_token_counts
from muara.llm.toxicity import op13_toxicity
from muara.llm.vector_codes import op11_vector_codes

REGISTRY = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_pseudonyms": op2_pseudonyms,
    "op3_simhash": op3_simhash,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_quality_rules": op5_quality_rules,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_license_scan": op7_license_scan,
    "op8_token_counts": op8_token_counts,
    "op9_decontaminate": op9_decontaminate,
    "op10_secret_scan": op10_secret_scan,
    "op11_vector_codes": op11_vector_codes,
    "op12_resampling": op12_resampling,
    "op13_toxicity": op13_toxicity,
    "pipeline": corpus_pipeline.run,
}
