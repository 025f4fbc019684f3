"""Column-expression helpers (pure ``pyspark.sql.functions`` compositions)."""

from .hashing import seeded_md5, hash_unit, hash_prefix  # noqa: F401
from .missing import as_missing  # noqa: F401
