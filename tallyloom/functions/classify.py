"""Status, category and team of a partner."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import labels
from .dates import month_start
from .text import strip


def classify_status(first_sale: Column, already_before: Column, month_first: Column) -> Column:
    """By first sale: before the programme, before this month, or not before this month."""
    return (
        F.when(first_sale < already_before, F.lit(labels.STATUS_ALREADY_ACTIVE))
        .when(first_sale < month_first, F.lit(labels.STATUS_ACTIVATED))
        .otherwise(F.lit(labels.STATUS_INACTIVE))
    )


def classify_category(dp_category: Column, first_sale_done: Column, quote_month: Column) -> Column:
    """A favourite whose first completed sale falls in the quote month still counts as inactive."""
    favourite = dp_category == labels.CATEGORY_FAVOURITE
    first_this_month = month_start(first_sale_done) == quote_month
    return F.when(favourite & ~F.coalesce(first_this_month, F.lit(False)), F.lit(labels.CATEGORY_FAVOURITE)).otherwise(
        F.lit(labels.CATEGORY_INACTIVE)
    )


def classify_team(team: Column) -> Column:
    return F.coalesce(team, F.lit(labels.TEAM_UNKNOWN))


def status_is(status: Column, *names: str) -> Column:
    """Status comparison that ignores blanks around the text and is never null."""
    return F.coalesce(strip(status).isin(*names), F.lit(False))


def is_inactive(status: Column) -> Column:
    return status_is(status, labels.STATUS_INACTIVE)


def is_favourite(status: Column) -> Column:
    return status_is(status, *labels.FAVOURITE_STATUSES)


def run_mode(subject: str | None, received: str | None, target_month: str | None) -> str:
    """The mode of a run follows from which parameters were given."""
    manual, catch_up, regular = labels.RUN_MODES
    if subject and received:
        return manual
    return catch_up if target_month else regular
