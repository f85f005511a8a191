"""The token codec: AES-256-CBC under a SHA-256 key, the IV in front, url-safe base64 around."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_of(secret: Column) -> Column:
    """32 key bytes of a shared secret."""
    return F.unhex(F.sha2(secret, 256))


def seal(text: Column, secret: Column) -> Column:
    return F.translate(F.base64(F.aes_encrypt(text, key_of(secret), F.lit("CBC"), F.lit("PKCS"))), "+/\r\n", "-_")


def unseal(token: Column, secret: Column) -> Column:
    """The sealed text; null where the token was not sealed with this secret."""
    raw = F.try_to_binary(F.translate(token, "-_", "+/"), F.lit("base64"))
    return F.try_aes_decrypt(raw, key_of(secret), F.lit("CBC"), F.lit("PKCS")).cast("string")
