from .cleaning import (  # noqa: F401
    is_missing,
    open_end,
    parse_date,
    parse_number,
    parse_timestamp,
    present,
    reason_defaults,
)
from .ranking import (  # noqa: F401
    count_copies,
    exact_median,
    hash_key,
    keep_top,
    running_totals,
    split_row_number,
)
