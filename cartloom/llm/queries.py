"""The operators as queries over the tables of a directory, and SQL where it can say them."""

from cartloom.llm.chat import OP2_SQL, op2_chat_formatting
from cartloom.llm.html_text import op8_html_extraction
from cartloom.llm.metric_join import OP4_SQL, op4_embedding_near_dedup
from cartloom.llm.mixing import op3_mixing_sources
from cartloom.llm.ngram_bloom import op13_lm_scoring
from cartloom.llm.packing import op5_best_fit_packing
from cartloom.llm.periodic import op12_periodic_runs
from cartloom.llm.quality import OP6_SQL, op6_quality_rules
from cartloom.llm.sharding import op10_sharding
from cartloom.llm.simhash import op9_simhash_near_dedup
from cartloom.llm.spelling import OP11_SQL, op11_spelling_variants
from cartloom.llm.token_files import op7_token_id_files
from cartloom.llm.toxicity import op1_toxicity

QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_chat_formatting,
        op3_mixing_sources,
        op4_embedding_near_dedup,
        op5_best_fit_packing,
        op6_quality_rules,
        op7_token_id_files,
        op8_html_extraction,
        op9_simhash_near_dedup,
        op10_sharding,
        op11_spelling_variants,
        op12_periodic_runs,
        op13_lm_scoring,
    )
}

ORACLE_SQL = {
    "op2_chat_formatting": OP2_SQL,
    "op4_embedding_near_dedup": OP4_SQL,
    "op6_quality_rules": OP6_SQL,
    "op11_spelling_variants": OP11_SQL,
}
