"""Column-level helpers; every function returns a JVM-side Column."""

from tillhouse.functions.text import strip, norm, initcap_alnum, clean_title  # noqa: F401
from tillhouse.functions.keys import surrogate_key  # noqa: F401
from tillhouse.functions.calendar import (  # noqa: F401
    iso_dow, year_month, month_label, day_name, is_weekend)
from tillhouse.functions.numeric import money, half_even, to_consumer  # noqa: F401
