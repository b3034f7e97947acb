"""The registered queries of these operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clientbook.llm import (
    bpe, conversation_repair, cross_polytope, exact_dedup, line_crf, minhash, mixing, token_files, toxicity, url_lists, warc, whitening, winnowing,
)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_line_crf": line_crf.query,
        "op2_winnowing": winnowing.query,
        "op3_mixing": mixing.query,
        "op4_bpe": bpe.query,
        "op5_cross_polytope": cross_polytope.query,
        "op6_warc_revisits": warc.query,
        "op7_token_files": token_files.query,
        "op8_toxicity": toxicity.query,
        "op9_minhash": minhash.query,
        "op10_url_lists": url_lists.query,
        "op11_whitening": whitening.query,
        "op12_exact_dedup": exact_dedup.query,
        "op13_conversation_repair": conversation_repair.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_mixing": mixing.SQL,
        "op5_cross_polytope": cross_polytope.SQL,
        "op6_warc_revisits": warc.SQL,
        "op9_minhash": minhash.SQL,
        "op10_url_lists": url_lists.SQL,
        "op12_exact_dedup": exact_dedup.SQL,
        "op13_conversation_repair": conversation_repair.SQL,
    }
