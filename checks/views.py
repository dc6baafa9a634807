"""Inputs of the registered queries, derived by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.functions.hashing import standard_normal, uniform
from parlance.operators import pairs, trajectory
from parlance.operators.ranking import number_turns
from parlance.operators.sequences import previous_value
from parlance.sources import conversations as conv
from parlance.sources.files import read_parquet


SPREAD = "spark.parlance.partitions"


def _iso(instant: Column) -> Column:
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss")


class Views:
    """Lazy views over one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def table(self, name: str, partitions: int | None = None) -> DataFrame:
        return read_parquet(self.spark, f"{self.folder}/{name}.parquet", partitions)

    def spread(self, name: str) -> DataFrame:
        """A table under expensive expressions; the benchmark names a number of partitions, as its files are single ones."""
        partitions = self.spark.conf.get(SPREAD, None)
        return self.table(name, int(partitions) if partitions else None)

    def documents(self) -> DataFrame:
        """For the text-heavy queries."""
        return self.spread("documents")

    # conversation tables: one record per order, per event, from their own cells
    def train(self) -> DataFrame:
        priority, price, status = F.col("o_orderpriority"), F.col("o_totalprice"), F.col("o_orderstatus")
        return self.spread("orders").select(
            F.col("o_orderkey").alias("id"),
            F.format_string("CUST_%06d", F.col("o_custkey")).alias("customer_id"),
            F.when(priority.isin("1-URGENT", "2-HIGH"), "Electronics").when(priority == "3-MEDIUM", "Clothing")
            .when(priority == "5-LOW", "Home").otherwise("Sports").alias("product_category"),
            F.when(price >= 300000, "positive").when(price >= 100000, "neutral").otherwise("negative").alias("sentiment"),
            _iso(F.col("o_orderdate")).alias("timestamp"),
            F.concat(F.lit("My order of "), F.year("o_orderdate"), F.lit(" is "), priority).alias("conversation_text"),
            F.when(status == "F", "purchase").when(status == "O", "abandon").otherwise("escalate").alias("outcome"),
        )

    def prod(self) -> DataFrame:
        kind, value = F.col("event_type"), F.col("value")
        return self.spread("events").select(
            F.col("event_id").alias("id"),
            F.format_string("PROD_%06d", F.col("user_id")).alias("customer_id"),
            F.when(kind == "signup", "Electronics").when(kind == "click", "Clothing").when(kind == "view", "Home")
            .otherwise("Sports").alias("product_category"),
            F.when(value >= 30, "positive").when(value >= 10, "neutral").otherwise("negative").alias("sentiment"),
            _iso(F.col("ts")).alias("timestamp"),
            F.col("props").alias("conversation_text"),
            F.when(kind == "purchase", "purchase").when(kind == "error", "escalate").otherwise("abandon").alias("outcome"),
        )

    def dirty(self) -> DataFrame:
        return conv.with_quality_problems(self.train(), "id")

    def docs_labeled(self) -> DataFrame:
        return self.table("documents").join(self.table("labels"), "doc_id", "left")

    def texts(self) -> DataFrame:
        return self.table("documents").select("lang", "source", "text")

    # pairs
    def sft(self) -> DataFrame:
        return pairs.sft_pairs(self.train(), "id")

    def doc_preferences(self) -> DataFrame:
        context = F.concat("lang", F.lit("|"), "source").alias("context")
        return self.table("documents").join(self.table("labels"), "doc_id").select(
            "doc_id", context, F.col("text").alias("response"), "quality"
        )

    def turns(self) -> DataFrame:
        """User turns with the assistant's next turn; both sides are unique per (conversation, turn)."""
        c = self.table("conversations")
        user = c.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("context"))
        reply = c.where(F.col("role") == "assistant").select(
            "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response")
        )
        return user.join(reply, ["conv_id", "turn"]).select(
            F.concat_ws(":", "conv_id", "turn").alias("pair_id"), "context", "response"
        )

    # logged interactions: ten consecutive events are one conversation
    def steps(self) -> DataFrame:
        e = F.floor(F.col("event_id") / 10).cast("bigint")
        turn = F.pmod("event_id", F.lit(10)).cast("int")
        return self._stateful(self.table("events").withColumns({"episode": e, "turn": turn}), e, max_turns=10)

    # or the events of a user's day are; every fifth user is unknown, and their events are one long conversation
    def day_steps(self) -> DataFrame:
        known = F.col("user_id") % 5 != 0
        day = F.when(known, F.concat_ws("|", "user_id", F.to_date("ts").cast("string")))
        numbered = number_turns(self.table("events").withColumn("episode", day), "episode", ["event_id"])
        return self._stateful(numbered.withColumn("turn", F.col("turn").cast("int")), F.col("user_id"), max_turns=None)

    def _stateful(self, events: DataFrame, e: Column, max_turns: int | None) -> DataFrame:
        purchased = F.col("event_type") == "purchase"
        segment = F.element_at(F.array(*map(F.lit, ["new", "regular", "vip"])), (F.pmod(e, F.lit(3)) + 1).cast("int"))
        category = F.element_at(F.array(*map(F.lit, conv.CATEGORIES)), (F.pmod(e, F.lit(4)) + 1).cast("int"))
        described = events.select(
            "event_id", "user_id", "episode", "turn",
            F.pmod(F.col("event_id") * 7 + F.col("user_id"), F.lit(6)).cast("int").alias("action"),
            purchased.alias("purchased"),
            (F.col("event_type") == "error").alias("escalated"),
            F.when(purchased, F.lit(0.95)).otherwise(F.least(F.lit(1.0), F.col("value") / 100.0))
            .alias("satisfaction_after"),
            segment.alias("customer_segment"), category.alias("product_category"),
            (F.pmod(e, F.lit(10)) < 3).alias("mentioned_issue"), (F.pmod(e, F.lit(10)) >= 6).alias("asked_about_price"),
        )
        stateful = previous_value(described, "episode", "turn", "satisfaction_after", 0.55, "satisfaction", max_turns=max_turns)
        reward = trajectory.step_reward(
            F.col("satisfaction"), F.col("satisfaction_after"), F.col("purchased"), F.col("escalated")
        )
        return stateful.withColumn("reward", reward)

    def terminal(self):
        return trajectory.is_terminal(
            F.col("turn") + 1, F.col("purchased"), F.col("escalated"), F.col("satisfaction_after")
        )

    def episodes(self) -> DataFrame:
        """Steps up to the first terminal one."""
        return trajectory.until_terminal(self.steps(), self.terminal(), max_turns=10)

    def train_log(self) -> DataFrame:
        e = self.table("events").select(
            F.datediff("ts", F.lit("2024-01-01")).alias("epoch"), "event_id", "event_type",
            (F.col("value") / 100.0).alias("loss"),
        )
        return number_turns(e, "epoch", ["event_id"], "batch").withColumn("batch", (F.col("batch") + 1).cast("int"))

    def scored(self) -> DataFrame:
        signal = F.when(F.col("quality") == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        return self.table("labels").join(self.table("documents").select("doc_id", "source"), "doc_id").select(
            "doc_id", "source", F.col("quality").cast("double").alias("label"),
            (signal + standard_normal("logit", F.col("doc_id"))).alias("score"),
        )

    def ppo_steps(self) -> DataFrame:
        logp = lambda tag: F.ln(uniform(tag, F.col("event_id")) * 0.9 + 0.05)
        return self.steps().withColumns({
            "old_logp": logp("old"), "new_logp": logp("new"),
            "advantage": trajectory.advantage(F.col("reward"), F.col("satisfaction")),
        })
