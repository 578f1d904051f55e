"""Sealing of columns with AES-GCM under a 32-byte key."""

from __future__ import annotations

import hashlib
import hmac
import os

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

KEY_BYTES = 32


def check_key(key: bytes) -> bytes:
    if not isinstance(key, (bytes, bytearray)) or len(key) != KEY_BYTES:
        raise ValueError(f"the key must be {KEY_BYTES} bytes")
    return bytes(key)


def key_to_hex(key: bytes) -> str:
    return bytes(key).hex()


def key_from_hex(text: str) -> bytes:
    return check_key(bytes.fromhex(text))


def key_column(spark: SparkSession, key: bytes) -> Column:
    """The key as a scalar subquery, so that its bytes are in no plan text."""
    return spark.createDataFrame([(bytearray(check_key(key)),)], "k binary").scalar()


def seal(value: Column, key: Column, bound_to: Column) -> Column:
    """Encrypt a binary or string column; the result opens only next to the same ``bound_to``."""
    return F.aes_encrypt(value.cast("binary"), key, F.lit("GCM"), F.lit("DEFAULT"),
                         F.lit(bytearray()), bound_to)


def unseal(value: Column, key: Column, bound_to: Column) -> Column:
    return F.aes_decrypt(value, key, F.lit("GCM"), F.lit("DEFAULT"), bound_to)


def fingerprint(key: bytes, salt: str) -> str:
    return hashlib.sha256(bytes.fromhex(salt) + check_key(key)).hexdigest()


def new_salt() -> str:
    return os.urandom(16).hex()


def require_key(key: bytes, salt: str, expected: str) -> None:
    if not hmac.compare_digest(fingerprint(key, salt), expected):
        raise PermissionError("the key is not the one this collection was created with")
