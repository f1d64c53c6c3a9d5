"""Column-level building blocks: lenient casts and compiled rules."""

from lakeproof.functions.casts import (coerce, lenient_float, lenient_int, lenient_timestamp,
                                       numeric_text_key)
from lakeproof.functions.rules import CompiledRules, compile_rules

__all__ = [
    "CompiledRules", "coerce", "compile_rules", "lenient_float", "lenient_int",
    "lenient_timestamp", "numeric_text_key",
]
