"""The queries of this subpackage and, where SQL expresses them, their SQL."""

from __future__ import annotations

from . import bpe, chat, dedup, hamming, htmltext, jaccard, packing, toxicity, urlfilter, warc

QUERIES = {
    "op1_warc": warc.op1_warc,
    "op2_packing": packing.op2_packing,
    "op3_url_reputation": urlfilter.op3_url_reputation,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_topk_hamming": hamming.op5_topk_hamming,
    "op6_ngram_jaccard": jaccard.op6_ngram_jaccard,
    "op7_byte_bpe": bpe.op7_byte_bpe,
    "op8_chat_format": chat.op8_chat_format,
    "op9_html_text": htmltext.op9_html_text,
    "op10_exact_dedup": dedup.op10_exact_dedup,
}

ORACLE_SQL = {
    "op1_warc": warc.OP1_SQL,
    "op3_url_reputation": urlfilter.OP3_SQL,
    "op5_topk_hamming": hamming.OP5_SQL,
    "op6_ngram_jaccard": jaccard.OP6_SQL,
    "op8_chat_format": chat.OP8_SQL,
    "op10_exact_dedup": dedup.OP10_SQL,
}
