"""Training-data operators: one module per operator, queries in ``queries``.

Nothing else in the library imports this subpackage. Functions that run in
Python workers are shipped with the task (pickled by value), so executors
need no copy of the package.
"""

from pyspark import cloudpickle

from tessera.llm import (
    byte_bpe, chat_format, common, exact_dedup, importance, lm_score, near_dedup, nearest, packing, pii, quality_rules,
    source_audit, suffix_dedup, url_filter,
)

for _module in (byte_bpe, chat_format, common, exact_dedup, importance, lm_score, near_dedup, nearest, packing, pii,
                quality_rules, source_audit, suffix_dedup, url_filter):
    cloudpickle.register_pickle_by_value(_module)
