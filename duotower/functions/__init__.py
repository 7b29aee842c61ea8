"""Column-level building blocks: vector math, stable hashes, global ranking."""

from duotower.functions.hashing import md5_u32, md5_unit, sql_md5_u32  # noqa: F401
from duotower.functions.ranking import global_row_index, ordered_prefix_sum  # noqa: F401
from duotower.functions.vectors import (  # noqa: F401
    bce_with_logits, checksum, concat_features, dense_layer, dot, mlp, round_half_even, sigmoid, zeros,
)
