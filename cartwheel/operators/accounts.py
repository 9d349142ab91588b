"""User ingestion, lookup, sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import token_hash

# Default session lifetime in hours.
SESSION_TTL_HOURS = 24


def ingest_users(batch: DataFrame, users: DataFrame):
    """G1: register a batch (seq, full_name, email, password_hash, phone).

    Email is lower-cased; request rules (name 2..120, email 6..255 with an
    '@', phone <= 20) and the CHECK (an '@' after the first character) are
    applied; an email already stored or taken by an earlier accepted row is
    rejected.  The first accepted row becomes admin when no admin exists.
    Returns (accepted, rejected).
    """
    b = batch.select("seq", "full_name", F.col("email").alias("raw_email"), "password_hash", "phone",
                     F.lower("email").alias("email"))
    L = F.length
    static = (F.when(F.col("full_name").isNull() | (L("full_name") < 2) | (L("full_name") > 120),
                     "name length must be 2..120")
              .when(F.col("raw_email").isNull() | (L("raw_email") < 6) | (L("raw_email") > 255),
                    "email length must be 6..255")
              .when(L(F.coalesce("phone", F.lit(""))) > 20, "phone longer than 20")
              .when(~F.col("email").contains("@"), "Please provide a valid email address.")
              .when(F.locate("@", F.col("email")) <= 1, "email must have a local part"))
    stored = users.select(F.lower("email").alias("email"), F.lit(True).alias("_taken"))
    b = b.withColumn("_static", static).join(stored, "email", "left")
    # the first candidate of an email takes it: a partial minimum, joined back
    first = (b.filter(F.col("_static").isNull() & F.col("_taken").isNull())
             .groupBy("email").agg(F.min("seq").alias("_taken_at")))
    b = b.join(first, "email", "left")
    reason = F.coalesce(F.col("_static"), F.when(F.col("_taken").isNotNull() | (F.col("_taken_at") < F.col("seq")),
                                                   F.lit("Email already registered.")))
    b = b.withColumn("reject_reason", reason)
    ok = b.filter(F.col("reject_reason").isNull())
    has_admin = users.filter(F.col("is_admin")).select(F.count(F.lit(1))).scalar() > 0
    first_seq = ok.select(F.min("seq")).scalar()
    accepted = ok.select("seq", "full_name", "email", "password_hash", "phone",
                         F.lit(True).alias("is_active"),
                         (~has_admin & (F.col("seq") == first_seq)).alias("is_admin"))
    rejected = b.filter(F.col("reject_reason").isNotNull()).select("seq", "raw_email", "reject_reason")
    return accepted, rejected


def find_users(users: DataFrame, lookups: DataFrame, by: str = "email") -> DataFrame:
    """Users matching lookups by case-folded email or by id (semi-join)."""
    if by == "email":
        keys = lookups.select(F.lower("email").alias("_k")).distinct()
        u = users.withColumn("_k", F.lower("email"))
        return u.join(keys, "_k", "left_semi").select(
            "user_id", "full_name", "email", "password_hash", "is_active", "is_admin")
    return users.join(lookups.select("user_id").distinct(), "user_id", "left_semi").select(
        "user_id", "full_name", "email", "is_active", "is_admin")


def start_sessions(logins: DataFrame, secret: str, ttl_hours: int = SESSION_TTL_HOURS) -> DataFrame:
    """G3 + G6: session rows for logins (seq, user_id, at, token).

    expires_at = at + ttl; only the token's SHA-256 (with the secret) is kept.
    """
    return logins.select(
        F.col("seq").alias("session_id"), "user_id", token_hash("token", secret).alias("token_hash"),
        (F.col("at") + F.make_interval(hours=F.lit(ttl_hours))).alias("expires_at"),
        F.lit(None).cast("timestamp_ntz").alias("revoked_at"),
        F.lit(None).cast("timestamp_ntz").alias("last_used_at"),
        F.col("at").alias("created_at"))


def active_sessions(sessions: DataFrame, users: DataFrame, as_of, require_active_user: bool = False) -> DataFrame:
    """Sessions not revoked and expiring strictly after ``as_of``, with user fields."""
    ts = F.lit(as_of).cast("timestamp_ntz")
    s = sessions.filter(F.col("revoked_at").isNull() & (F.col("expires_at") > ts))
    out = s.join(users.select("user_id", "full_name", "email", "is_active", "is_admin"), "user_id")
    if require_active_user:
        out = out.filter(F.col("is_active"))
    return out.select("session_id", "user_id", "expires_at", "full_name", "email", "is_active", "is_admin")


def fold_sessions(sessions: DataFrame, events: DataFrame) -> DataFrame:
    """Apply USE / LOGOUT events (seq, session_id, kind, at) to sessions.

    revoked_at is the first LOGOUT (revocation does not check expiry); a
    USE counts only before expiry and before that LOGOUT, and sets
    last_used_at to the latest such use.  Refused uses are counted.  Two
    partial aggregates and a join, no per-session ordering.
    """
    ev = events.filter(F.col("kind").isin("USE", "LOGOUT"))
    revoke = ev.filter(F.col("kind") == "LOGOUT").groupBy("session_id").agg(
        F.min(F.struct("seq", "at")).alias("_first_logout"))
    uses = (ev.filter(F.col("kind") == "USE").select("session_id", "seq", "at")
            .join(sessions.select("session_id", "expires_at"), "session_id")
            .join(revoke, "session_id", "left"))
    valid = (F.col("at") < F.col("expires_at")) & (
        F.col("_first_logout").isNull() | (F.col("seq") < F.col("_first_logout.seq")))
    used = uses.groupBy("session_id").agg(
        F.max(F.when(valid, F.col("at"))).alias("_last_used"),
        F.count(F.when(~valid, 1)).alias("refused_uses"))
    s = sessions.join(revoke, "session_id", "left").join(used, "session_id", "left")
    return s.select(
        "session_id", "user_id", "expires_at",
        F.coalesce("revoked_at", F.col("_first_logout.at")).alias("revoked_at"),
        F.coalesce("_last_used", "last_used_at").alias("last_used_at"),
        F.coalesce("refused_uses", F.lit(0)).cast("bigint").alias("refused_uses"))


def pseudonymise_token(df: DataFrame, col: str, secret: str, out: str | None = None) -> DataFrame:
    """Replace (or add as ``out``) a token column by SHA-256 hex of ``token:secret``."""
    return df.withColumn(out or col, token_hash(col, secret))
