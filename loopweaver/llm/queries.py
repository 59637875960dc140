"""The corpus operators' queries, by name, and their SQL where SQL can express them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loopweaver.llm import oracles
from loopweaver.llm.bpe import op8_bpe_round_trip
from loopweaver.llm.common import scratch
from loopweaver.llm.embed_dedup import op1_embedding_dedup
from loopweaver.llm.exact_dedup import op11_exact_dedup
from loopweaver.llm.hard_negatives import op13_hard_negatives
from loopweaver.llm.licenses import op9_license_scan
from loopweaver.llm.lm_score import op5_lm_score
from loopweaver.llm.minhash import op2_minhash_dedup
from loopweaver.llm.packing import op7_curve_packing
from loopweaver.llm.quality import op6_quality_rules
from loopweaver.llm.secrets import op4_secret_scan
from loopweaver.llm.toxicity import op3_toxic_passages
from loopweaver.llm.vector_codes import op12_va_codes
from loopweaver.llm.warc import op10_warc_round_trip

_ALL = (
    op1_embedding_dedup, op2_minhash_dedup, op3_toxic_passages, op4_secret_scan, op5_lm_score, op6_quality_rules, op7_curve_packing,
    op8_bpe_round_trip, op9_license_scan, op10_warc_round_trip, op11_exact_dedup, op12_va_codes, op13_hard_negatives,
)


def _tidy(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """f, leaving nothing but its result in the shared folder."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with scratch() as keep:
            return keep(f(spark, sf_dir))

    return run


QUERIES = {f.__name__: _tidy(f) for f in _ALL}
#: Learnt scores, tokenizer ids, references and linked spans are beyond SQL; tests/llm holds those against brute force.
ORACLE = {"op1_embedding_dedup": oracles.OP1, "op2_minhash_dedup": oracles.OP2, "op5_lm_score": oracles.OP5, "op10_warc_round_trip": oracles.OP10, "op11_exact_dedup": oracles.OP11, "op12_va_codes": oracles.OP12, "op13_hard_negatives": oracles.OP13}
