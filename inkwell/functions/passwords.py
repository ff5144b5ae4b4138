"""Stored password hashes, written as method$salt$hex."""

import functools
import hashlib
import hmac

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType


# The most that the library gives to one hash.
MOST_MEMORY = (1 << 31) - 1


def scrypt_memory(n: int, r: int, p: int) -> int:
    """Bytes that a hash of this cost works in, with some room."""
    return 128 * r * (n + p + 2) + (1 << 20)


def password_matches(stored: str | None, given: str | None) -> bool | None:
    """Whether `given` hashes to `stored`; text that is no known hash never matches. None if the
    hash needs more than MOST_MEMORY, so that nothing can be said."""
    if stored is None or given is None or stored.count("$") < 2:
        return False
    method, salt, digest = stored.split("$", 2)
    name, *settings = method.split(":")
    secret, salt_bytes = given.encode(), salt.encode()
    try:
        if name == "pbkdf2" and len(settings) == 2:
            found = hashlib.pbkdf2_hmac(settings[0], secret, salt_bytes, int(settings[1]))
        elif name == "scrypt" and len(settings) == 3:
            n, r, p = map(int, settings)
            if n > 1 and r > 0 and p > 0 and n & (n - 1) == 0 and scrypt_memory(n, r, p) > MOST_MEMORY:
                return None
            found = hashlib.scrypt(secret, salt=salt_bytes, n=n, r=r, p=p, maxmem=scrypt_memory(n, r, p))
        else:
            return False
    except (ValueError, OverflowError):
        return False
    return hmac.compare_digest(found.hex().encode(), digest.encode())


@F.pandas_udf(BooleanType())
def _verify(stored: pd.Series, given: pd.Series) -> pd.Series:
    check = functools.cache(password_matches)
    return pd.Series([check(s, g) for s, g in zip(stored, given)], dtype="boolean")


def verify_password(stored: Column, given: Column) -> Column:
    """Slow on purpose, as the hash is: spread the rows evenly over tasks first.

    A pair that repeats within a batch is hashed once. NULL where password_matches can't tell.
    """
    return _verify(stored, given)


def hash_method(stored: Column) -> Column:
    """Method and digest without their settings, such as pbkdf2:sha256 or scrypt."""
    method = F.regexp_extract(stored, r"^([a-z]\w*(?::[a-z]\w*)?)(?::\d+)*\$", 1)
    return F.nullif(method, F.lit(""))


def hash_iterations(stored: Column) -> Column:
    """Iteration count of a pbkdf2 hash, NULL for other methods."""
    return F.nullif(F.regexp_extract(stored, r"^pbkdf2:\w+:(\d+)\$", 1), F.lit("")).try_cast("bigint")
