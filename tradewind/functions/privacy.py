"""Protection of personal data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keys are passed as columns of a key table, never as literals: a literal would show in the plan.


def encrypt(col: Column, key: Column) -> Column:
    """AES-GCM with a random nonce; binary result."""
    return F.aes_encrypt(col.cast("string"), key)


def decrypt(col: Column, key: Column) -> Column:
    return F.aes_decrypt(col, key).cast("string")


def salted_hash(col: Column, salt: Column) -> Column:
    """Stable pseudonym: equal inputs give equal outputs, so joins still work."""
    return F.sha2(F.concat(salt, col.cast("string")), 256)
