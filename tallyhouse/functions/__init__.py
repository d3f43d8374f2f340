from tallyhouse.functions.dates import (  # noqa: F401
    calendar_columns,
    calendar_days,
    date_key,
    days_between,
    elapsed_ms,
    elapsed_seconds,
    in_range,
    minute_of,
    month_of,
    year_label,
)
from tallyhouse.functions.keys import (  # noqa: F401
    base64_text,
    canonical,
    clean_text,
    content_hash,
    geography_key,
    surrogate_key,
)
from tallyhouse.functions.lsn import (  # noqa: F401
    lsn_to_text,
    operation_name,
    text_to_lsn,
)
from tallyhouse.functions.measures import (  # noqa: F401
    discount_band,
    label,
    money,
    net_revenue,
    or_zero,
    percent,
    ratio,
    revenue_segment,
)
