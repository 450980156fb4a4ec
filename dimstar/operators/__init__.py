from dimstar.operators.conform import conform_union, not_in_authority  # noqa: F401
from dimstar.operators.joins import hot_keys, one_to_many_left_join, salted_left_join  # noqa: F401
from dimstar.operators.latest import latest_per_key  # noqa: F401
