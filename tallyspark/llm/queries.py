"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from tallyspark.llm.chat_format import OP4_SQL, op4_chat_format
from tallyspark.llm.chroma import cut_recordings_aligned, op10_chroma_fingerprints
from tallyspark.llm.divergence import OP11_SQL, op11_source_divergence
from tallyspark.llm.exact_dedup import OP5_SQL, op5_exact_dedup
from tallyspark.llm.language_id import op7_language_id
from tallyspark.llm.merge_dropout import op8_sentencepiece_dropout
from tallyspark.llm.minmax_hash import OP13_SQL, op13_minmax_near_dedup
from tallyspark.llm.mixing import OP6_SQL, op6_mixing
from tallyspark.llm.ngram_join import OP3_SQL, op3_ngram_jaccard_join
from tallyspark.llm.suffix_dedup import op9_suffix_array_dedup
from tallyspark.llm.toxicity import op1_toxicity
from tallyspark.llm.warc_zip import OP2_SQL, op2_warc_zip
from tallyspark.llm.whitening import op12_embedding_whitening

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_warc_zip": op2_warc_zip,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_chat_format": op4_chat_format,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_mixing": op6_mixing,
    "op7_language_id": op7_language_id,
    "op8_sentencepiece_dropout": op8_sentencepiece_dropout,
    "op9_suffix_array_dedup": op9_suffix_array_dedup,
    "op10_chroma_fingerprints": op10_chroma_fingerprints,
    "cut_recordings_aligned": cut_recordings_aligned,
    "op11_source_divergence": op11_source_divergence,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_minmax_near_dedup": op13_minmax_near_dedup,
}

SQL = {
    "op2_warc_zip": OP2_SQL,
    "op3_ngram_jaccard_join": OP3_SQL,
    "op4_chat_format": OP4_SQL,
    "op5_exact_dedup": OP5_SQL,
    "op6_mixing": OP6_SQL,
    "op11_source_divergence": OP11_SQL,
    "op13_minmax_near_dedup": OP13_SQL,
}
