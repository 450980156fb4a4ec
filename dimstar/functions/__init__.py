from dimstar.functions.columns import (  # noqa: F401
    blank_to_null,
    first_match,
    key_text,
    mail_domain,
    parse_flag,
    pick,
    seconds_between,
)
