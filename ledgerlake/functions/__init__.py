"""Column expressions. Everything here returns a `Column` built from Spark built-ins."""

from ledgerlake.functions.oracle import (  # noqa: F401
    blank_to_null, messages, to_number, is_bad_number, parse_date3, is_bad_date,
    not_in_guarded, holds_word,
)
from ledgerlake.functions.text import (  # noqa: F401
    clean_invoice_text, split_pieces, lenient_double, collapse_ws, strip_ws,
    file_name_of, file_dir_of, file_ext_of,
)
from ledgerlake.functions.dates import (  # noqa: F401
    last_day_of_next_month, aging_bucket, parse_dmy, format_mdy, normalise_date_text, date_stamp,
)
from ledgerlake.functions.labels import priority, product_type, funder_label  # noqa: F401
