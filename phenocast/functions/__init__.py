"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from phenocast.functions.dates import (  # noqa: F401
    calendar_parts,
    day_length_seconds,
    parse_mixed_date,
    parse_timestamp,
)
from phenocast.functions.numeric import (  # noqa: F401
    half_even_int,
    hash64,
    normal_z,
    numeric_aware_key,
    round_doubles,
    sentinel_to_null,
)
from phenocast.functions.quantiles import kth_smallest, kth_smallest_many  # noqa: F401
