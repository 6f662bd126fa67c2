"""One query per operator, on the whole given tables, and the SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventlab.llm.alignment import op12_alignment
from eventlab.llm.chat_format import op1_chat_format
from eventlab.llm.decontamination import op9_decontamination
from eventlab.llm.embedding_dedup import op10_embedding_dedup
from eventlab.llm.exact_topk import op11_exact_topk
from eventlab.llm.language_id import op7_language_id
from eventlab.llm.licenses import op2_license_scan
from eventlab.llm.merkle import op13_merkle_manifest
from eventlab.llm.minhash_dedup import op3_minhash_dedup
from eventlab.llm.pieces import op6_sentencepiece
from eventlab.llm.sharding import op8_sharding
from eventlab.llm.suffix_dedup import op5_suffix_dedup
from eventlab.llm.token_binary import op4_token_binary
from eventlab.llm.twins import SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_chat_format, op2_license_scan, op3_minhash_dedup, op4_token_binary, op5_suffix_dedup, op6_sentencepiece, op7_language_id, op8_sharding,
              op9_decontamination, op10_embedding_dedup, op11_exact_topk, op12_alignment, op13_merkle_manifest)
}
__all__ = ["QUERIES", "SQL"]
