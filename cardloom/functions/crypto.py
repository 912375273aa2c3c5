"""AES-256-GCM columns in the layout base64(nonce 12 | ciphertext | tag 16)."""

from __future__ import annotations

import base64
import binascii
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEY_VARIABLE = "ENCRYPTION_KEY"


def key_from_env() -> str:
    """Base64 key from the environment, checked before any job starts."""
    return checked_key(os.environ.get(KEY_VARIABLE))


def checked_key(key: str | None) -> str:
    if not key:
        raise ValueError(f"{KEY_VARIABLE} is not set")
    try:
        raw = base64.b64decode(key, validate=True)
    except (binascii.Error, ValueError) as exc:
        raise ValueError(f"{KEY_VARIABLE} is not base64") from exc
    if len(raw) != 32:
        raise ValueError(f"{KEY_VARIABLE} must hold 32 bytes, not {len(raw)}")
    return key


def key_column(spark: SparkSession, key: str) -> Column:
    """The key as a scalar subquery over a one-row table, so that no plan text
    shows it and encryption is never folded to one shared nonce."""
    one_row = spark.createDataFrame([(checked_key(key),)], "k string")
    return one_row.select(F.unbase64("k")).scalar()


def encrypted(x: Column, key: Column) -> Column:
    """Ciphertext of the value as text; NULL and '' give NULL. ``x`` must be a
    column, not a literal: each row then gets its own nonce."""
    plain = F.nullif(x.cast("string"), F.lit(""))
    return F.translate(F.base64(F.aes_encrypt(plain, key, F.lit("GCM"))), "\r\n", "")


def decrypted(x: Column, key: Column) -> Column:
    """Clear text; a wrong key or a damaged value ends the job."""
    return F.aes_decrypt(F.unbase64(F.nullif(x, F.lit(""))), key, F.lit("GCM")).cast("string")


def decrypted_or_null(x: Column, key: Column) -> Column:
    """Clear text, NULL for a wrong key or a damaged value."""
    return F.try_aes_decrypt(F.unbase64(F.nullif(x, F.lit(""))), key, F.lit("GCM")).cast("string")


def encrypt_columns(df: DataFrame, columns: list[str], key: str) -> DataFrame:
    """Replaces the columns by their ciphertext. A re-run gives new ciphertext,
    so write the result once and read that."""
    k = key_column(df.sparkSession, key)
    return df.withColumns({c: encrypted(F.col(c), k) for c in columns})


def decrypt_columns(df: DataFrame, columns: list[str], key: str) -> DataFrame:
    k = key_column(df.sparkSession, key)
    return df.withColumns({c: decrypted(F.col(c), k) for c in columns})


def pseudonym(x: Column, salt: Column) -> Column:
    """Keyed, one-way id."""
    return F.sha2(F.concat(x.cast("string"), salt), 256)
