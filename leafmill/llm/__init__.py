"""Operators of a training-data pipeline; nothing else in the library imports them."""

from __future__ import annotations

from leafmill.llm._common import clear  # noqa: F401  for whoever has read the results
from leafmill.llm.bpe import op4_bpe
from leafmill.llm.decontaminate import OP3_SQL, op3_decontaminate
from leafmill.llm.embeddup import op9_embeddup
from leafmill.llm.langid import op1_langid
from leafmill.llm.linededup import OP2_SQL, op2_linededup
from leafmill.llm.minhash import OP10_SQL, op10_minhash
from leafmill.llm.quotes import OP8_SQL, op8_quotes
from leafmill.llm.sharding import op6_sharding
from leafmill.llm.suffixdedup import OP7_SQL, op7_suffixdedup
from leafmill.llm.toxicity import op5_toxicity


def queries():
    return {
        "op1_langid": op1_langid,
        "op2_linededup": op2_linededup,
        "op3_decontaminate": op3_decontaminate,
        "op4_bpe": op4_bpe,
        "op5_toxicity": op5_toxicity,
        "op6_sharding": op6_sharding,
        "op7_suffixdedup": op7_suffixdedup,
        "op8_quotes": op8_quotes,
        "op9_embeddup": op9_embeddup,
        "op10_minhash": op10_minhash,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_linededup": OP2_SQL,
        "op3_decontaminate": OP3_SQL,
        "op7_suffixdedup": OP7_SQL,
        "op8_quotes": OP8_SQL,
        "op10_minhash": OP10_SQL,
    }
