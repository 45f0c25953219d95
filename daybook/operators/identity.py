"""Identity-matching payloads: which events qualify, what is sent, what came back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from daybook.functions.text import not_blank
from daybook.schema import NULL_TEXT, REPLY_SCHEMA


def eligible(mode: str = "documented") -> Column:
    """Identity-eligible events.

    ``documented``: auth or login events whose unionid, userid and phoneNo are
    all present (not blank).
    ``observed``: the rule as the reference evaluates it, ``auth OR (login AND
    ...)``, on line fields where a missing value reads ``\\N`` (not blank), so
    only login rows with a whitespace-only value are dropped.
    """
    kind = F.col("dataType")
    ids = [F.col("unionid"), F.col("userid"), F.col("phoneNo")]
    if mode == "documented":
        ok = kind.isin("auth", "login")
        for c in ids:
            ok = ok & not_blank(c)
        return ok
    if mode == "observed":
        login_ok = F.coalesce(kind == "login", F.lit(False))
        for c in ids:
            login_ok = login_ok & not_blank(F.coalesce(c, F.lit(NULL_TEXT)))
        return F.coalesce(kind == "auth", F.lit(False)) | login_ok
    raise ValueError(f"unknown mode {mode!r}")


def identity_eligible(flat: DataFrame, mode: str = "documented") -> DataFrame:
    return flat.where(eligible(mode))


def identity_body(mode: str = "documented") -> Column:
    """JSON body of one identity pair.  ``documented`` leaves NULL members
    out; ``observed`` sends a missing member as the text ``\\N``, which is
    what the reference reads from its line."""
    ids = [F.col("unionid").alias("unionId"), F.col("openid").alias("openId")]
    if mode == "observed":
        ids = [F.coalesce("unionid", F.lit(NULL_TEXT)).alias("unionId"),
               F.coalesce("openid", F.lit(NULL_TEXT)).alias("openId")]
    return F.to_json(F.struct(*ids))


def identity_outbox(flat: DataFrame, mode: str = "documented",
                    keep: list[str] | None = None) -> DataFrame:
    """``keep..., body``: one payload per eligible event, for a separate sender."""
    return identity_eligible(flat, mode).select(*(keep or []), identity_body(mode).alias("body"))


def decode_reply(reply: Column) -> Column:
    """Reply text -> ``code, status, msg, data`` (``data`` kept as JSON text).

    Empty or non-JSON replies give a NULL ``code``."""
    return F.from_json(reply, REPLY_SCHEMA)


def reply_audit(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """``code, n``: replies per status code."""
    return (replies.select(decode_reply(F.col(reply))["code"].alias("code"))
            .groupBy("code").agg(F.count(F.lit(1)).alias("n")))
