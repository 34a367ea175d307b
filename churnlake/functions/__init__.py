from churnlake.functions.flags import (  # noqa: F401
    flag_any_eq, flag_cmp, flag_eq, flag_icontains, flag_in, flag_ne, is_value, ntz_lit,
)
from churnlake.functions.hashing import unit_hash, unit_hash_sql  # noqa: F401
