"""Schemas of every table the reports read or write, and the column check."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

STRING, INT, BIGINT, DOUBLE, DATE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.DateType()
MOMENT = T.TimestampNTZType()


def money(digits: int = 18) -> T.DecimalType:
    return T.DecimalType(digits, 2)


def exact_money() -> T.DecimalType:
    """Money that serves as a key: unrounded."""
    return T.DecimalType(38, 10)


def table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


SALES_RAW = table(
    row_seq=BIGINT,
    sale_date=DATE,
    bdm_name=STRING,
    dp_id=STRING,
    net_premium=STRING,
)
SALES_ENRICHED = table(
    row_seq=BIGINT,
    sale_date=DATE,
    bdm_name=STRING,
    dp_id=STRING,
    net_premium=STRING,
    dp_status=STRING,
)
PARTNER = table(
    dpno=STRING,
    partner_id=STRING,
)
POLICY = table(
    login_id=STRING,
    policy_id=STRING,
    created_at=MOMENT,
    net_premium=money(),
    vertical=STRING,
    businesstype=STRING,
)
QUOTES = table(
    quote_id=STRING,
    dp_id=STRING,
    stage=STRING,
    creation_date=STRING,
    last_update_date=STRING,
)
DP_MASTER = table(
    dp_id=STRING,
    agent_mapped=STRING,
    dp_category=STRING,
    last_call_disposition=STRING,
    sqldate=STRING,
)
ROSTER = table(
    roster_seq=INT,
    email=STRING,
    team=STRING,
)
OVERRIDES = table(
    clean_name=STRING,
    email=STRING,
)
MESSAGES = table(
    message_id=BIGINT,
    sender=STRING,
    subject=STRING,
    received_at=MOMENT,
    attachments=T.ArrayType(STRING),
)
DP_STATUS = table(
    dpno=STRING,
    login_id=STRING,
    policy_count=BIGINT,
    total_netpremium=money(28),
    client_status=STRING,
)
SUPPLY = table(
    quote_month=DATE,
    agent_mapped=STRING,
    sum_inactive_dps_creating_quotes=BIGINT,
)
FAV_POOL = table(
    agent_mapped=STRING,
    team=STRING,
    dp_count=BIGINT,
)
MASTER = table(
    batch_seq=INT,
    row_seq=BIGINT,
    sale_date=DATE,
    bdm_name=STRING,
    dp_id=STRING,
    net_premium=exact_money(),
    dp_status=STRING,
    team=STRING,
)
TREND = table(
    data_date=DATE,
    act_numerator=BIGINT,
    act_denominator=BIGINT,
    activation_rate=DOUBLE,
    fav_numerator=BIGINT,
    fav_denominator=BIGINT,
    favourite_rate=DOUBLE,
    con_numerator=BIGINT,
    con_denominator=BIGINT,
    consolidated_rate=DOUBLE,
    avg_premium_inactive=DOUBLE,
    avg_premium_fav=DOUBLE,
    nop_per_dp_inactive=DOUBLE,
    nop_per_dp_fav=DOUBLE,
    run_mode=STRING,
    run_timestamp=T.TimestampType(),
)

COLLATE_REQUIRED = ["sale_date", "bdm_name", "dp_id", "net_premium", "dp_status"]


class MissingColumns(ValueError):
    """A batch lacks columns the job needs."""

    def __init__(self, missing: list[str]):
        super().__init__(f"missing columns: {missing}")
        self.missing = missing


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return [name for name in required if name not in df.columns]


def validate_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """The same frame, or MissingColumns naming what it lacks."""
    missing = missing_columns(df, required)
    if missing:
        raise MissingColumns(missing)
    return df


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip() for name in df.columns])


def drop_matching_columns(df: DataFrame, *fragments: str) -> DataFrame:
    """Drop every column whose name contains one of the fragments."""
    return df.drop(*[name for name in df.columns if any(part in name for part in fragments)])


def positional_select(df: DataFrame, positions: dict[int, str]) -> DataFrame:
    """Columns by position, renamed: ``{0: "key_id", 4: "new_status"}``."""
    return df.select(*[df[df.columns[at]].alias(name) for at, name in positions.items()])
