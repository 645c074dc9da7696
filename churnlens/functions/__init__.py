from churnlens.functions.scalar import (  # noqa: F401
    NUMBER_PATTERN,
    band,
    binarize,
    cut_index,
    cut_label,
    decode,
    pct,
    round_half_even,
    safe_ratio,
    to_number,
    trunc_int,
)
