"""The given tables in the shape of the transaction domain.

The tables are clean, so faults are put in by a mark, the first two hexadecimal digits of a hash of the
id. Each mark is a fault, every row stays, and the SQL of ``oracles`` makes the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskflow.fixed_values import RAW_COLUMNS, TIMESTAMP_FORMAT

HEADER = "#tranaction_id | " + " | ".join(RAW_COLUMNS[1:])


def _mark(column: str) -> Column:
    return F.substring(F.md5(F.col(column).cast("string")), 1, 2)


def _swap(mark: Column, faults: dict[str, Column], value: Column) -> Column:
    chain = value
    for name, fault in faults.items():
        chain = F.when(mark == name, fault).otherwise(chain)
    return chain


def raw_transactions(events: DataFrame) -> DataFrame:
    """Events as raw text transactions with faults: blanks, NaN, bad numbers and times, copies."""
    mark = F.col("mark")
    amount = F.col("value").cast("decimal(18,2)").cast("string")
    terminal = F.col("user_id").cast("string")
    moment = F.date_format("ts", TIMESTAMP_FORMAT)
    columns = {
        "tranaction_id": F.col("event_id").cast("string"),
        "tx_datetime": _swap(
            mark, {"0b": F.lit("   "), "0c": F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit(" 24:00:00"))}, moment
        ),
        "customer_id": _swap(
            mark,
            {
                "09": F.lit("0"),
                "0a": F.lit(None).cast("string"),
                "15": F.lit("17.5"),
                "16": F.lit("12345678901234567890"),
            },
            (F.col("user_id") + 1).cast("string"),
        ),
        "terminal_id": _swap(
            mark,
            {
                "05": F.lit("0"),
                "06": F.lit("1000"),
                "07": F.lit("abc"),
                "08": F.concat(F.lit(" "), terminal, F.lit(" ")),
            },
            terminal,
        ),
        "tx_amount": _swap(
            mark,
            {
                "00": F.lit(""),
                "01": F.lit("NaN"),
                "02": F.concat(F.lit("-"), amount),
                "03": F.lit("0"),
                "04": F.lit("0.5"),
            },
            amount,
        ),
        "tx_fraud": _swap(
            mark,
            {"0e": F.lit(None).cast("string"), "17": F.lit("2"), "18": F.lit("x")},
            F.when(F.col("event_type") == "error", "1").otherwise("0"),
        ),
        "tx_fraud_scenario": _swap(mark, {"0d": F.lit("")}, F.col("event_type")),
    }
    copies = _swap(mark, {"0f": F.lit(2), "10": F.lit(3)}, F.lit(1))
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return events.withColumn("mark", _mark("event_id")).select(F.inline(F.array_repeat(row, copies)))


def raw_lines(events: DataFrame) -> DataFrame:
    """The same as text lines with the day, some too short, some too long, and repeated headers."""
    raw = raw_transactions(events)
    mark = _mark("tranaction_id")
    fields = [F.coalesce(F.col(c), F.lit("")) for c in RAW_COLUMNS]
    line = _swap(
        mark,
        {
            "12": F.concat_ws(",", *fields[:-1]),
            "13": F.concat_ws(",", *fields, F.lit("x")),
            "14": F.lit(HEADER),
        },
        F.concat_ws(",", *fields),
    )
    day = F.coalesce(F.substring(F.trim("tx_datetime"), 1, 10), F.lit(""))
    return raw.select(line.alias("value"), F.when(day == "", "1970-01-01").otherwise(day).alias("day"))


def raw_files(events: DataFrame) -> DataFrame:
    """The same lines as files by day, each with its header first: (day, place, value).

    On even days customer and terminal have changed places, in the header and in complete rows.
    """
    lines = raw_lines(events)
    names = HEADER.split(" | ")
    names[2], names[3] = names[3], names[2]
    swapped = F.dayofmonth(F.col("day").try_cast("date")) % 2 == 0
    fields = F.split("value", ",")
    order = [F.get(fields, F.lit(i)) for i in (0, 1, 3, 2, 4, 5, 6)]
    moved = F.when(F.col("value") == HEADER, " | ".join(names)).when(
        F.size(fields) == len(names), F.concat_ws(",", *order)
    )
    rows = lines.select(
        "day", F.lit(1).alias("place"), F.coalesce(F.when(swapped, moved), F.col("value")).alias("value")
    )
    header = F.when(swapped, " | ".join(names)).otherwise(HEADER)
    headers = lines.select("day").distinct().select("day", F.lit(0).alias("place"), header.alias("value"))
    return rows.unionByName(headers)


def lineitem_transactions(lineitem: DataFrame) -> DataFrame:
    """Line items as typed transactions: suppliers are terminals, returned items are frauds."""
    return lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("tranaction_id"),
        F.col("l_suppkey").cast("int").alias("terminal_id"),
        F.col("l_extendedprice").alias("tx_amount"),
        (F.col("l_returnflag") == "R").cast("int").alias("tx_fraud"),
        F.col("l_linestatus").alias("tx_fraud_scenario"),
    )


def order_transactions(orders: DataFrame) -> DataFrame:
    """Orders as transactions: customers are terminals, urgent orders are frauds."""
    return orders.select(
        F.col("o_orderkey").alias("tranaction_id"),
        F.col("o_custkey").alias("terminal_id"),
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("tx_fraud"),
    )


def messages(events: DataFrame) -> DataFrame:
    """Events as JSON messages in the layout of a Kafka source, some of them faulty."""
    mark = F.col("mark")
    moment = F.concat(F.lit('{"ts":"'), F.date_format("ts", TIMESTAMP_FORMAT), F.lit('",'))
    page = F.get_json_object("props", "$.k")
    user = F.col("user_id").cast("string")
    page_field = F.concat(F.lit('"page_id":"'), page, F.lit('"}'))
    full = F.concat(moment, F.lit('"user_id":"'), user, F.lit('",'), page_field)
    value = _swap(
        mark,
        {
            "00": F.lit("not json"),
            "01": F.concat(moment, F.lit('"user_id":"'), user, F.lit('"}')),
            "02": F.concat(moment, F.lit('"user_id":'), user, F.lit(","), page_field),
            "03": F.concat(moment, F.lit('"user_id":null,'), page_field),
            "04": F.concat(moment, F.lit('"extra":1,"user_id":"'), user, F.lit('",'), page_field),
            "05": F.lit(None).cast("string"),
        },
        full,
    )
    return events.withColumn("mark", _mark("event_id")).select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit("transactions").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def rule_predictions(events: DataFrame) -> DataFrame:
    """Two fixed rules as models: (model, tranaction_id, tx_fraud, prediction)."""
    error = F.col("event_type") == "error"
    rules = {
        "LR": (error & (F.col("value") > 2.0)) | ((F.col("event_type") == "click") & (F.col("value") > 25.0)),
        "LR_TV": (error & (F.col("value") > 1.0)) | ((F.col("event_type") == "click") & (F.col("value") > 30.0)),
    }
    models = F.array(
        *[
            F.struct(F.lit(name).alias("model"), rule.cast("int").cast("double").alias("prediction"))
            for name, rule in rules.items()
        ]
    )
    return events.select(
        F.inline(models),
        F.col("event_id").alias("tranaction_id"),
        error.cast("int").alias("tx_fraud"),
        F.col("ts").cast("timestamp").alias("tx_datetime"),
        F.col("value").alias("tx_amount"),
    )
