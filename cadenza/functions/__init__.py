"""Column expressions (all built-in Spark expressions, codegen friendly)."""

from cadenza.functions.exprs import (  # noqa: F401
    STRIP_PATTERN, WS_CLASS, col_of, consolidate, first_token,
    hash_bucket, hash_key, is_missing_label, last_segment, map_literal,
    norm_key, safe_scale, split_tokens, strip_ws,
)
