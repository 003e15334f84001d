"""Encrypted columns: a codec that can be exchanged; by default AES in base64."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class AesCodec:
    """``key`` of 16, 24 or 32 characters, passed in by the caller and never stored. ECB where equal values must stay equal, GCM else."""

    key: str
    deterministic: bool = True

    def encrypt(self, c: Column) -> Column:
        return F.base64(F.aes_encrypt(c, F.lit(self.key), F.lit("ECB" if self.deterministic else "GCM")))

    def decrypt(self, c: Column) -> Column:
        return F.try_aes_decrypt(F.unbase64(c), F.lit(self.key), F.lit("ECB" if self.deterministic else "GCM")).cast("string")

    def decrypt_if_coded(self, c: Column, least: int = 20) -> Column:
        """Decrypt what looks encrypted (base64 and long), leave the rest."""
        coded = c.rlike("^[A-Za-z0-9+/]+={0,2}$") & (F.length(c) >= least) & (F.length(c) % 4 == 0)
        return F.when(coded, F.coalesce(self.decrypt(F.when(coded, c)), c)).otherwise(c)
