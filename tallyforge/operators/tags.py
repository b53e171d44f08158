"""Tagging: judges' votes, consensus, review lists and the decisions that follow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.columns import json_strings, parse_vote, share
from tallyforge.operators.silver import number_new
from tallyforge.sources.shared import written


def _contains(text: str) -> Column:
    """Whether question or description contains `text`, without regard to case."""
    pattern = "%" + text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_") + "%"
    return F.col("question").ilike(pattern) | F.col("description").ilike(pattern)


def search_markets(markets: DataFrame, text: str, active_only: bool = False, limit: int = 50, offset: int = 0) -> DataFrame:
    """Markets whose question or description contains `text`, without regard to case; largest volume first."""
    hit = _contains(text)
    out = markets.where(hit & F.col("active") if active_only else hit)
    return out.select("market_id", "question", "category", "volume").orderBy(F.desc_nulls_last("volume"), "market_id").offset(offset).limit(limit)


def votes(responses: DataFrame) -> DataFrame:
    """One vote per (tag, market, model).  A model that answered more than once and differently has no vote."""
    v = responses.select("tag_id", "market_id", "model", parse_vote("response").alias("vote"))
    same = F.min("vote") == F.max("vote")
    return v.groupBy("tag_id", "market_id", "model").agg(F.when(same, F.min("vote")).alias("vote"))


def consensus(responses: DataFrame, min_votes: int = 2, unanimous: bool = False) -> DataFrame:
    """One row per (tag, market): votes by model, counts, consensus (null if none) and the reason.

    Null votes don't count, and a repeated vote of a model counts once.  All equal: unanimous.  Otherwise, unless `unanimous` is asked for,
    yes wins with `min_votes`, then no; yes is looked at first.
    """
    v = votes(responses).groupBy("tag_id", "market_id").agg(
        F.count_if(F.col("vote")).alias("yes"), F.count_if(~F.col("vote")).alias("no"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("model", "vote")))).alias("judge_votes"),
    )
    reason = F.when((F.col("yes") == 0) & (F.col("no") == 0), "no_votes").when((F.col("yes") == 0) | (F.col("no") == 0), "unanimous")
    decided = F.when(F.col("reason") == "unanimous", F.col("yes") > 0)
    if unanimous:
        reason = reason.otherwise("no_consensus")
    else:
        enough = (F.col("yes") >= min_votes) | (F.col("no") >= min_votes)
        reason = reason.when(enough, "majority").otherwise("no_consensus")
        decided = decided.when(F.col("reason") == "majority", F.col("yes") >= min_votes)
    return v.withColumn("reason", reason).withColumn("consensus", decided)


def effective() -> Column:
    """The human decision, else the judges' consensus."""
    return F.coalesce("human_decision", "consensus")


def markets_for_tagging(
    tags: DataFrame, markets: DataFrame, market_tags: DataFrame, history: DataFrame, examples: DataFrame, n: int = 10, categories: list[str] | None = None
) -> DataFrame:
    """For each active tag not fully checked, the next `n` markets after its cursor that are not tagged, judged or exemplified.

    Markets and cursors are numbered together, so a tag's candidates are a range of numbers:
    as many as it needs, and one more for each known market and each cursor that could lie in
    it.  No more pairs are made than that, however many markets there are.  `categories`
    leaves the markets of other categories out.
    """
    if categories:
        markets = markets.where(F.col("category").isin(categories))
    known = market_tags.select("tag_id", "market_id").unionByName(history.select("tag_id", "market_id")).unionByName(examples.select("tag_id", "market_id"))
    open_tags = tags.where("is_active and not all_checked").select("tag_id", F.col("last_checked").cast("long").alias("after"))
    # Only what lies ahead of an open tag's cursor matters; it is written, as it is counted first and left out later.
    known = known.join(open_tags, "tag_id").where("market_id > after").select("tag_id", "market_id").distinct()
    known = written(known, "known")
    ids = markets.select(F.col("market_id").cast("long").alias("market_id"))
    numbers = written(number_new(ids.unionByName(open_tags.select(F.col("after").alias("market_id"))), "market_id", 0, "number"), "numbers")
    ahead = known.groupBy("tag_id").agg(F.count("*").alias("known"))
    room = open_tags.agg(F.count_distinct("after").alias("cursors"))
    wanted = (
        open_tags.join(numbers.select(F.col("market_id").alias("after"), "number"), "after").join(ahead, "tag_id", "left").join(F.broadcast(room))
        .select("tag_id", F.explode(F.sequence(F.col("number") + 1, F.col("number") + n + F.coalesce("known", F.lit(0)) + F.col("cursors"))).alias("number"))
    )
    pairs = wanted.join(numbers, "number").join(ids, "market_id", "left_semi").join(known, ["tag_id", "market_id"], "left_anti")
    order = Window.partitionBy("tag_id").orderBy("market_id")
    return pairs.withColumn("position", F.row_number().over(order)).where(F.col("position") <= n).select("tag_id", "market_id", "position")


def needing_review(history: DataFrame) -> DataFrame:
    return history.where("consensus is null and human_decision is null").select("tag_id", "market_id")


def classification_counts(tags: DataFrame, market_tags: DataFrame, history: DataFrame) -> DataFrame:
    """Per tag: assigned markets, and markets that judges or people turned down."""
    yes = market_tags.groupBy("tag_id").agg(F.count_distinct("market_id").alias("positives"))
    no = history.where("consensus = false or human_decision = false").groupBy("tag_id").agg(F.count_distinct("market_id").alias("negatives"))
    return tags.select("tag_id").join(yes, "tag_id", "left").join(no, "tag_id", "left").fillna(0)


def tag_list(tags: DataFrame, examples: DataFrame, active_only: bool = False) -> DataFrame:
    """Tags with their numbers of examples, positive and negative."""
    e = examples.groupBy("tag_id").agg(
        F.count("*").alias("examples"), F.count_if("is_positive").alias("positive"), F.count_if(~F.col("is_positive")).alias("negative")
    )
    out = tags.join(e, "tag_id", "left").fillna(0, ["examples", "positive", "negative"])
    return out.where("is_active") if active_only else out


def tag_categories(tags: DataFrame) -> DataFrame:
    """`tags` with their `categories`, a JSON array in a string, as an array; [] for null and for what is no array of strings."""
    return tags.withColumn("categories", F.coalesce(json_strings("categories"), F.array().cast("array<string>")))


def tag_examples(examples: DataFrame, markets: DataFrame, positive_only: bool | None = None) -> DataFrame:
    """Examples with their markets and their `position` in the tag, newest first; `positive_only` keeps one kind."""
    kept = examples if positive_only is None else examples.where(F.col("is_positive") == positive_only)
    order = Window.partitionBy("tag_id").orderBy(F.desc("created_at"), F.desc("example_id"))
    return kept.withColumn("position", F.row_number().over(order)).join(markets.select("market_id", "question", "description"), "market_id")


def judge_history(
    history: DataFrame, markets: DataFrame, n: int = 20, decision: str | None = None, source: str | None = None, search: str | None = None, category: str | None = None
) -> DataFrame:
    """The `n` entries per tag updated last, with their effective decision (Positive, Negative, Pending) and source (Human, LLM).

    `search` is contained in the market's question or description, without regard to case;
    `category` is the market's.  All filters come before the limit.
    """
    h = history.withColumn("decision", F.when(effective(), "Positive").when(~effective(), "Negative").otherwise("Pending"))
    h = h.withColumn("source", F.when(F.col("human_decision").isNotNull(), "Human").when(F.col("consensus").isNotNull(), "LLM"))
    if decision:
        h = h.where(F.col("decision") == decision)
    if source:
        h = h.where(F.col("source") == source)
    if search or category:
        m = markets.where(F.col("category") == category) if category else markets
        h = h.join((m.where(_contains(search)) if search else m).select("market_id"), "market_id", "left_semi")
    order = Window.partitionBy("tag_id").orderBy(F.desc("updated_at"), F.desc("market_id"))
    h = h.withColumn("position", F.row_number().over(order)).where(F.col("position") <= n)
    return h.join(markets.select("market_id", "question"), "market_id", "left").select("tag_id", "market_id", "decision", "source", "position", "question")


def pending_reviews(history: DataFrame, n: int = 10, majority_yes: bool = True) -> DataFrame:
    """Undecided by people, newest first, filtered before the limit."""
    h = history.where("human_decision is null")
    h = h.where("yes > no") if majority_yes else h
    order = Window.partitionBy("tag_id").orderBy(F.desc("updated_at"), F.desc("market_id"))
    return h.withColumn("position", F.row_number().over(order)).where(F.col("position") <= n).select("tag_id", "market_id", "yes", "no", "position")


def judge_prompts(tags: DataFrame, examples: DataFrame, markets: DataFrame, per_kind: int = 3) -> DataFrame:
    """A prompt per tag from its newest positive and negative examples; descriptions are cut at 500 characters."""
    newest = Window.partitionBy("tag_id", "is_positive").orderBy(F.desc("created_at"), F.desc("example_id"))
    e = tag_examples(examples, markets).withColumn("r", F.row_number().over(newest)).where(F.col("r") <= per_kind)
    line = F.concat(F.lit("- "), "question", F.lit(": "), F.left(F.coalesce("description", F.lit("")), F.lit(500)))
    parts = lambda flag: F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(F.when(F.col("is_positive") == flag, F.struct("r", line.alias("line"))))), lambda x: x["line"]))
    text = e.groupBy("tag_id").agg(parts(True).alias("yes"), parts(False).alias("no"))
    out = tags.where("is_active").join(text, "tag_id", "left")
    none = F.lit("(none)")
    return out.select(
        "tag_id",
        F.concat(
            F.lit("Tag: "), "name", F.lit("\nMeaning: "), F.coalesce("description", none), F.lit("\nBelongs:\n"), F.coalesce(F.nullif("yes", F.lit("")), none),
            F.lit("\nDoes not belong:\n"), F.coalesce(F.nullif("no", F.lit("")), none), F.lit("\nAnswer YES or NO."),
        ).alias("prompt"),
    )


def apply_decisions(market_tags: DataFrame, history: DataFrame) -> DataFrame:
    """Assignments after the effective decisions: true adds, false takes away, null leaves."""
    d = history.select("tag_id", "market_id", effective().alias("d"))
    kept = market_tags.select("tag_id", "market_id").join(d.where("not d"), ["tag_id", "market_id"], "left_anti")
    return kept.unionByName(d.where("d").select("tag_id", "market_id")).distinct()


def human_overrides(history: DataFrame, decisions: DataFrame) -> DataFrame:
    """`history` with the people's `decisions` (tag_id, market_id, decision, decided_at) put in: the last one counts.

    A decision on an entry that has one, or a second decision, is a correction.  The entry's
    `updated_at` becomes the time of the decision, so that it moves up in lists by time.
    """
    d = decisions.where("decision is not null").groupBy("tag_id", "market_id").agg(
        F.max(F.struct("decided_at", "decision")).alias("last"), F.count("*").alias("times")
    )
    out = history.join(d, ["tag_id", "market_id"], "left")
    first = F.col("human_decision").isNull() & (F.col("times") == 1)
    by = F.when(F.col("last").isNull(), F.col("decided_by")).when(first, "human").otherwise("human_correction")
    return out.withColumns({
        "decided_by": by, "human_decision": F.coalesce("last.decision", "human_decision"), "updated_at": F.coalesce("last.decided_at", "updated_at"),
    }).drop("last", "times")


def partial_update(rows: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """`rows` with the non-null columns of `updates` (at most one row a key) put over them."""
    names = [c for c in updates.columns if c != key]
    u = updates.select(key, *[F.col(c).alias(f"__{c}") for c in names])
    out = rows.join(u, key, "left")
    return out.select(*[F.coalesce(f"__{c}", c).alias(c) if c in names else F.col(c) for c in rows.columns])


def classification_batch(tags: DataFrame, candidates: DataFrame, examples: DataFrame, least: int = 2) -> DataFrame:
    """Per eligible tag (active, `least` examples, not all checked) its next markets; a tag without any is exhausted."""
    enough = examples.groupBy("tag_id").agg(F.count("*").alias("e")).where(F.col("e") >= least).select("tag_id")
    eligible = tags.where("is_active and not all_checked").select("tag_id").join(enough, "tag_id", "left_semi")
    lists = candidates.groupBy("tag_id").agg(F.array_sort(F.collect_list("market_id")).alias("batch"))
    out = eligible.join(lists, "tag_id", "left")
    return out.select("tag_id", F.coalesce("batch", F.array().cast("array<bigint>")).alias("batch"), F.col("batch").isNull().alias("exhausted"))


def history_metrics(history: DataFrame) -> DataFrame:
    human, llm = F.col("human_decision").isNotNull(), F.col("consensus").isNotNull()
    return history.agg(F.count("*").alias("total"), F.count_if(llm).alias("llm"), F.count_if(human).alias("human"), F.count_if(~human & ~llm).alias("pending"))


def judge_agreement(responses: DataFrame, history: DataFrame) -> DataFrame:
    """Per judge: votes on markets that people decided, and the share that agrees."""
    d = history.where("human_decision is not null").select("tag_id", "market_id", "human_decision")
    v = votes(responses).where("vote is not null").join(d, ["tag_id", "market_id"])
    return v.groupBy("model").agg(F.count("*").alias("votes"), share(F.count_if(F.col("vote") == F.col("human_decision")), F.count("*")).alias("agreement"))


def cascade_delete(tag_id: int, **tables: DataFrame) -> dict[str, DataFrame]:
    """Every table without the rows of one tag."""
    return {name: t.where(~F.col("tag_id").eqNullSafe(F.lit(tag_id))) for name, t in tables.items()}
