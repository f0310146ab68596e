"""Registered queries of this subpackage and their DuckDB SQL."""

from lorebank.llm.bpe_codec import op10_bpe_codec
from lorebank.llm.decontaminate import OP2_SQL, op2_decontaminate
from lorebank.llm.exact_dedup import OP5_SQL, op5_exact_dedup
from lorebank.llm.language_model import op9_language_model
from lorebank.llm.licenses import op12_licenses
from lorebank.llm.near_dedup import op8_near_dedup
from lorebank.llm.periodic_runs import op11_periodic_runs
from lorebank.llm.quality import op1_quality
from lorebank.llm.secrets import op6_secrets
from lorebank.llm.sharding import op3_sharding
from lorebank.llm.token_counts import op4_token_counts
from lorebank.llm.toxicity import op7_toxicity
from lorebank.llm.whitening import op13_whitening

QUERIES = {
    "op1_quality": op1_quality,
    "op2_decontaminate": op2_decontaminate,
    "op3_sharding": op3_sharding,
    "op4_token_counts": op4_token_counts,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_secrets": op6_secrets,
    "op7_toxicity": op7_toxicity,
    "op8_near_dedup": op8_near_dedup,
    "op9_language_model": op9_language_model,
    "op10_bpe_codec": op10_bpe_codec,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_licenses": op12_licenses,
    "op13_whitening": op13_whitening,
}

ORACLE_SQL = {
    "op2_decontaminate": OP2_SQL,
    "op5_exact_dedup": OP5_SQL,
}
