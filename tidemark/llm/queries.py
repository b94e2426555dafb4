"""The queries of the numbered operators and the SQL that states their results, where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import crossalign, maxscore, metricjoin, mincut, neardup, orcids, packing, pitmanyor, pseudonyms, quality, ranks, turnrepair, viterbi, wordpiece
from .common import table

PII_KEY = "tidemark-demo-key"  # a deployment passes its own secret

BYTE_BPE = ranks.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
TOKENIZERS = crossalign.Pair(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"),
                             public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, merges=True)

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mincut_extract": lambda s, d: mincut.op1(table(s, d, "pages")),
    "op2_maxscore_topk": lambda s, d: maxscore.op2(table(s, d, "embeddings")),
    "op3_orc_token_ids": lambda s, d: orcids.op3(table(s, d, "documents"), public_tokenizers.path("word_bpe_49k.json")),
    "op4_linear_wordpiece": lambda s, d: wordpiece.op4(table(s, d, "documents"), public_tokenizers.path("piece_bpe_32k.model")),
    "op5_pseudonyms": lambda s, d: pseudonyms.op5(table(s, d, "documents"), PII_KEY),
    "op6_superminhash": lambda s, d: neardup.op6(table(s, d, "documents")),
    "op7_viterbi_pieces": lambda s, d: viterbi.op7(table(s, d, "documents"), public_tokenizers.path("piece_bpe_32k.model")),
    "op8_nnls_packing": lambda s, d: packing.op8(table(s, d, "documents"), BYTE_BPE),
    "op9_quality_rules": lambda s, d: quality.op9(table(s, d, "documents")),
    "op10_pitman_yor": lambda s, d: pitmanyor.op10(table(s, d, "documents")),
    "op11_turn_repair": lambda s, d: turnrepair.op11(table(s, d, "conversations")),
    "op12_cross_alignment": lambda s, d: crossalign.op12(table(s, d, "documents"), TOKENIZERS),
    "op13_metric_join": lambda s, d: metricjoin.op13(table(s, d, "embeddings")),
}

SQL: dict[str, str] = {"op2_maxscore_topk": maxscore.SQL, "op9_quality_rules": quality.SQL}
