"""The registered queries of this subpackage, the pipeline included."""

from __future__ import annotations

import corpus_pipeline
from helixspark.llm.chat import op10_chat_format
from helixspark.llm.embeddings import op6_embedding_dedup
from helixspark.llm.lexical import OP11_SQL, op11_ranked_search
from helixspark.llm.lexicon import op4_bpe_lexicon
from helixspark.llm.linededup import OP13_SQL, op13_line_dedup
from helixspark.llm.packing import op1_mixture_packing
from helixspark.llm.paragraphs import op5_paragraph_dedup
from helixspark.llm.phrases import OP12_SQL, op12_phrase_mining
from helixspark.llm.pii import op8_pii_crf
from helixspark.llm.quality import op7_quality_rules
from helixspark.llm.secrets import op3_secret_scan
from helixspark.llm.setsketch import op2_setsketch_dedup
from helixspark.llm.toxicity import op9_toxicity
from helixspark.plans.registry import Query


def llm_queries() -> dict[str, Query]:
    fns = {f.__name__: f for f in (
        op1_mixture_packing, op2_setsketch_dedup, op3_secret_scan, op4_bpe_lexicon, op5_paragraph_dedup,
        op6_embedding_dedup, op7_quality_rules, op8_pii_crf, op9_toxicity, op10_chat_format,
        op11_ranked_search, op12_phrase_mining, op13_line_dedup)}
    fns["pipeline"] = corpus_pipeline.run
    sql = {"pipeline": corpus_pipeline.ORACLE_SQL, "op11_ranked_search": OP11_SQL, "op12_phrase_mining": OP12_SQL, "op13_line_dedup": OP13_SQL}
    return {name: Query(name, f, sql.get(name)) for name, f in fns.items()}
