"""Choice of the sales batch out of a table of message metadata."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import tokenize_subject


def first_workbook(attachments) -> "F.Column":
    """The first attachment that is a workbook, or null."""
    return F.get(F.filter(attachments, lambda name: F.lower(name).rlike(r"\.xlsx?$")), F.lit(0))


def matching_messages(
    messages: DataFrame,
    senders: Sequence[str],
    subject: str,
    received: dt.date | None = None,
) -> DataFrame:
    """Messages of a known sender with every word of ``subject`` in their subject line.

    With ``received`` the message must have come within one day of it.
    """
    sender = F.lower(F.coalesce("sender", F.lit("")))
    line = F.lower(F.coalesce("subject", F.lit("")))
    known = F.exists(F.array(*[F.lit(s.lower()) for s in senders]), lambda s: F.contains(sender, s))
    all_words = F.forall(tokenize_subject(F.lit(subject)), lambda word: F.contains(line, word))
    kept = messages.filter(known & all_words)
    if received is not None:
        first, last = received - dt.timedelta(days=1), received + dt.timedelta(days=1)
        kept = kept.filter(F.col("received_at").cast("date").between(F.lit(first), F.lit(last)))
    return kept


def pick_top1(messages: DataFrame, preferred: str) -> DataFrame:
    """A message of the preferred sender if there is one, else any; the newest of them."""
    from_preferred = F.contains(F.lower("sender"), F.lit(preferred.lower()))
    order = [from_preferred.desc(), F.col("received_at").desc(), F.col("message_id").desc()]
    return messages.orderBy(*order).limit(1)


def select_message(
    messages: DataFrame,
    senders: Sequence[str],
    preferred: str,
    subject: str,
    received: dt.date | None = None,
) -> DataFrame:
    """The message to take the batch from, with the name of its first workbook."""
    chosen = pick_top1(matching_messages(messages, senders, subject, received), preferred)
    return chosen.select(
        "message_id", "sender", "subject", "received_at", first_workbook(F.col("attachments")).alias("workbook")
    )
