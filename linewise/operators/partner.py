"""Which partner a line belongs to, who may see it, and what must not be on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.references import partner_ref

APPROVED = "approved"


def with_references(apps: DataFrame) -> DataFrame:
    """The app registry with each app's reference, computed once per app and token. An
    app without key or token has none.

    The reference is declared non-null: otherwise a join on it makes Catalyst push
    "reference is not null", and with it the whole HMAC, below the registry's distinct
    and on to every row of the scan."""
    known = apps.filter(F.col("tenant_token").isNotNull() & F.col("app_key").isNotNull())
    return known.withColumn("partner_ref", F.coalesce(partner_ref("tenant_token", "app_key"), F.lit("")))


def approved_references(apps: DataFrame) -> DataFrame:
    return with_references(apps.filter(F.col("state") == APPROVED)).select("tenant_id", "partner_ref", "app_id")


def resolve_partner(lines: DataFrame, apps: DataFrame, previous_tokens: DataFrame | None = None) -> DataFrame:
    """Adds ``app_id``, null when the reference is no approved app's of the tenant.

    Exact equality on (tenant, reference). The registry carries no broadcast hint: its
    size is known at run time, when AQE broadcasts it if it fits and otherwise splits
    the skewed line side of a shuffled join.

    ``previous_tokens`` (tenant_id, tenant_token, valid_to_s) also accepts references
    of a replaced token on lines no later than ``valid_to_s`` (column ``seen_s``)."""
    known = approved_references(apps)
    if previous_tokens is None:
        return lines.join(known, ["tenant_id", "partner_ref"], "left")
    old = (
        apps.filter(F.col("state") == APPROVED)
        .drop("tenant_token")
        .join(previous_tokens, "tenant_id")
    )
    old = with_references(old).select("tenant_id", "partner_ref", "app_id", "valid_to_s")
    current = known.withColumn("valid_to_s", F.lit(None).cast("bigint"))
    # one row per reference: a current token outlives any earlier validity
    every = (
        current.unionByName(old)
        .groupBy("tenant_id", "partner_ref")
        .agg(
            F.max("app_id").alias("app_id"),
            F.when(F.count_if(F.col("valid_to_s").isNull()) == 0, F.max("valid_to_s")).alias("valid_to_s"),
        )
    )
    joined = lines.join(every, ["tenant_id", "partner_ref"], "left")
    in_time = F.col("valid_to_s").isNull() | (F.col("seen_s") <= F.col("valid_to_s"))
    return joined.withColumn("app_id", F.when(in_time, F.col("app_id"))).drop("valid_to_s")


def matched_lines(lines: DataFrame, apps: DataFrame) -> DataFrame:
    return lines.join(approved_references(apps), ["tenant_id", "partner_ref"], "left_semi")


def unmatched_lines(lines: DataFrame, apps: DataFrame) -> DataFrame:
    return lines.join(approved_references(apps), ["tenant_id", "partner_ref"], "left_anti")


def partner_visible(lines: DataFrame) -> DataFrame:
    """What a partner may see: attributed lines, never outbound ones."""
    inbound = F.coalesce("direction", F.lit("inbound")) == "inbound"
    return lines.filter(F.col("app_id").isNotNull() & inbound)


def secret_forms(apps: DataFrame) -> DataFrame:
    """(tenant_id, form, secret) rows: the tenant token, and each app key as it is and
    as the spellings of its SHA-256."""
    digest = F.sha2(F.encode("app_key", "UTF-8"), 256)
    base64 = F.base64(F.unhex(digest))
    forms = F.map_from_arrays(
        F.array(*[F.lit(n) for n in ("key", "sha256_hex", "sha256_upper", "sha256_base64", "sha256_base64url")]),
        F.array(
            F.col("app_key"),
            digest,
            F.upper(digest),
            base64,
            F.regexp_replace(F.translate(base64, "+/", "-_"), "=+$", ""),
        ),
    )
    keys = apps.select("tenant_id", F.explode(forms).alias("form", "secret"))
    tokens = apps.select("tenant_id", F.lit("token").alias("form"), F.col("tenant_token").alias("secret"))
    return keys.unionByName(tokens).filter(F.col("secret") != "").distinct()
