"""Tagging queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.functions.columns import parse_vote
from tallyforge.operators import tags as t
from tallyforge.registry import query

VOTES = "votes AS (SELECT tag_id, market_id, model, CASE WHEN upper(trim(response)) LIKE '%YES%' THEN TRUE WHEN upper(trim(response)) LIKE '%NO%' THEN FALSE END AS vote FROM judge_responses)"
CON = VOTES + """,
c AS (SELECT tag_id, market_id, count(CASE WHEN vote THEN 1 END) AS yes, count(CASE WHEN NOT vote THEN 1 END) AS no,
 string_agg(model || '=' || coalesce(CAST(vote AS VARCHAR), 'none'), ',' ORDER BY model) AS judge_votes FROM votes GROUP BY 1, 2),
r AS (SELECT *, CASE WHEN yes = 0 AND no = 0 THEN 'no_votes' WHEN yes = 0 OR no = 0 THEN 'unanimous' WHEN {maj} THEN 'majority' ELSE 'no_consensus' END AS reason FROM c)
SELECT tag_id, market_id, yes, no, judge_votes, reason, CASE WHEN reason = 'unanimous' THEN yes > 0 WHEN reason = 'majority' THEN yes >= 2 END AS consensus FROM r"""
KNOWN = "known AS (SELECT tag_id, market_id FROM market_tags UNION SELECT tag_id, market_id FROM history UNION SELECT tag_id, market_id FROM tag_examples)"
NEXT = KNOWN + """,
nxt AS (SELECT * FROM (SELECT g.tag_id, m.market_id, row_number() OVER (PARTITION BY g.tag_id ORDER BY m.market_id) AS position FROM tags g JOIN markets m ON m.market_id > g.last_checked
 WHERE g.is_active AND NOT g.all_checked AND NOT EXISTS (SELECT 1 FROM known k WHERE k.tag_id = g.tag_id AND k.market_id = m.market_id)) x WHERE position <= 10)"""


def nxt(v):
    return t.markets_for_tagging(v.tags, v.markets, v.market_tags, v.history, v.tag_examples)


def spelled(rows):
    """`rows` with the map of votes as text, in the order of the models."""
    votes = F.transform(F.map_entries("judge_votes"), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"].cast("string"), F.lit("none"))))
    return rows.withColumn("judge_votes", F.array_join(votes, ","))


def decisions(v):
    """One decision on every fifth market, a later one that reverses it on every fifteenth."""
    once = v.history.where("market_id % 5 = 0").selectExpr("tag_id", "market_id", "market_id % 3 = 0 AS decision", "updated_at + INTERVAL '36' HOUR AS decided_at")
    return once.unionByName(once.where("market_id % 15 = 0").selectExpr("tag_id", "market_id", "not decision AS decision", "decided_at + INTERVAL '5' HOUR AS decided_at"))


query(
    "search_markets",
    """SELECT market_id, question, category, volume FROM markets WHERE question ILIKE '%al%' OR description ILIKE '%al%'
 ORDER BY volume DESC NULLS LAST, market_id LIMIT 50 OFFSET 10""",
)(lambda v: t.search_markets(v.markets, "al", limit=50, offset=10))
query(
    "parse_votes",
    f"WITH {VOTES} SELECT * FROM votes",
)(lambda v: v.judge_responses.select("tag_id", "market_id", "model", parse_vote("response").alias("vote")))
query("consensus", "WITH " + CON.format(maj="yes >= 2 OR no >= 2"))(lambda v: spelled(t.consensus(v.judge_responses)))
query("consensus_unanimous", "WITH " + CON.format(maj="FALSE"))(lambda v: spelled(t.consensus(v.judge_responses, unanimous=True)))
query("markets_for_tagging", f"WITH {NEXT} SELECT * FROM nxt")(nxt)
query(
    "needing_review",
    "SELECT tag_id, market_id FROM history WHERE consensus IS NULL AND human_decision IS NULL",
)(lambda v: t.needing_review(v.history))
query(
    "classification_counts",
    """SELECT t.tag_id, coalesce(a.n, 0) AS positives, coalesce(b.n, 0) AS negatives FROM tags t LEFT
 JOIN (SELECT tag_id, count(DISTINCT market_id) AS n FROM market_tags GROUP BY 1) a ON t.tag_id = a.tag_id LEFT
 JOIN (SELECT tag_id, count(DISTINCT market_id) AS n FROM history WHERE consensus = FALSE OR human_decision = FALSE
 GROUP BY 1) b ON t.tag_id = b.tag_id""",
)(lambda v: t.classification_counts(v.tags, v.market_tags, v.history))
query(
    "distinct_categories",
    "SELECT category, count(*) AS markets FROM markets WHERE category IS NOT NULL GROUP BY category",
)(lambda v: v.markets.where("category is not null").groupBy("category").agg(F.count("*").alias("markets")))
query(
    "tag_list",
    """SELECT t.*, coalesce(e.examples, 0) AS examples, coalesce(e.positive, 0) AS positive, coalesce(e.negative, 0) AS negative FROM tags t LEFT
 JOIN (SELECT tag_id, count(*) AS examples, count(CASE WHEN is_positive THEN 1 END) AS positive, count(CASE WHEN NOT is_positive THEN 1 END) AS negative
 FROM tag_examples GROUP BY 1) e ON t.tag_id = e.tag_id""",
)(lambda v: t.tag_list(v.tags, v.tag_examples))
EXAMPLES = "SELECT e.*, m.question, m.description FROM (SELECT *, row_number() OVER (PARTITION BY tag_id ORDER BY created_at DESC, example_id DESC) AS position FROM tag_examples{where}) e JOIN markets m ON e.market_id = m.market_id"
query("tag_examples", EXAMPLES.format(where=""))(lambda v: t.tag_examples(v.tag_examples, v.markets))
query("tag_examples_positive", EXAMPLES.format(where=" WHERE is_positive"))(lambda v: t.tag_examples(v.tag_examples, v.markets, positive_only=True))
query(
    "tag_categories",
    "SELECT tag_id, CASE WHEN tag_id % 5 IN (3, 4) THEN ['PROMO', name] ELSE [] END AS categories FROM tags",
)(lambda v: t.tag_categories(v.tags).select("tag_id", "categories"))
query(
    "markets_for_tagging_in_categories",
    "WITH " + NEXT.replace("JOIN markets m", "JOIN (SELECT * FROM markets WHERE category IN ('PROMO', 'ECONOMY')) m") + " SELECT * FROM nxt",
)(lambda v: t.markets_for_tagging(v.tags, v.markets, v.market_tags, v.history, v.tag_examples, categories=["PROMO", "ECONOMY"]))
HIST = """h AS (SELECT *, CASE WHEN coalesce(human_decision, consensus) THEN 'Positive' WHEN NOT coalesce(human_decision, consensus) THEN 'Negative' ELSE 'Pending' END AS decision,
 CASE WHEN human_decision IS NOT NULL THEN 'Human' WHEN consensus IS NOT NULL THEN 'LLM' END AS source FROM history)"""
query(
    "judge_history",
    f"""WITH {HIST} SELECT x.tag_id, x.market_id, decision, source, position, m.question FROM (SELECT *, row_number() OVER (PARTITION BY tag_id
 ORDER BY updated_at DESC, market_id DESC) AS position FROM h) x LEFT JOIN markets m ON x.market_id = m.market_id WHERE position <= 20""",
)(lambda v: t.judge_history(v.history, v.markets))
query(
    "judge_history_human_negative",
    f"""WITH {HIST} SELECT x.tag_id, x.market_id, decision, source, position, m.question FROM (SELECT *, row_number() OVER (PARTITION BY tag_id
 ORDER BY updated_at DESC, market_id DESC) AS position FROM h WHERE decision = 'Negative' AND source = 'Human') x LEFT
 JOIN markets m ON x.market_id = m.market_id WHERE position <= 20""",
)(lambda v: t.judge_history(v.history, v.markets, decision="Negative", source="Human"))
query(
    "judge_history_search",
    f"""WITH {HIST} SELECT x.tag_id, x.market_id, decision, source, position, m.question FROM (SELECT *, row_number() OVER (PARTITION BY tag_id ORDER BY updated_at DESC, market_id DESC) AS position FROM h
 WHERE market_id IN (SELECT market_id FROM markets WHERE category = 'PROMO' AND (question ILIKE '%A%' OR description ILIKE '%A%'))) x LEFT JOIN markets m ON x.market_id = m.market_id WHERE position <= 20""",
)(lambda v: t.judge_history(v.history, v.markets, search="A", category="PROMO"))
query(
    "pending_reviews",
    """SELECT tag_id, market_id, yes, no, position FROM (SELECT *, row_number() OVER (PARTITION BY tag_id
 ORDER BY updated_at DESC, market_id DESC) AS position FROM history WHERE human_decision IS NULL AND yes > no) x WHERE position <= 10""",
)(lambda v: t.pending_reviews(v.history))
PART = "string_agg(CASE WHEN is_positive = {flag} THEN '- ' || question || ': ' || left(coalesce(description, ''), 500) END, chr(10) ORDER BY r)"
query(
    "judge_prompts",
    f"""WITH e AS (SELECT * FROM (SELECT x.*, m.question, m.description, row_number() OVER (PARTITION BY tag_id, is_positive ORDER BY created_at DESC, example_id DESC) AS r FROM tag_examples x JOIN markets m ON x.market_id = m.market_id) y WHERE r <= 3),
 p AS (SELECT tag_id, {PART.format(flag='TRUE')} AS yes, {PART.format(flag='FALSE')} AS no FROM e GROUP BY tag_id)
 SELECT t.tag_id, 'Tag: ' || name || chr(10) || 'Meaning: ' || coalesce(description, '(none)') || chr(10) || 'Belongs:' || chr(10) || coalesce(yes, '(none)') || chr(10) || 'Does not belong:' || chr(10)
  || coalesce(no, '(none)') || chr(10) || 'Answer YES or NO.' AS prompt FROM tags t LEFT JOIN p ON t.tag_id = p.tag_id WHERE t.is_active""",
)(lambda v: t.judge_prompts(v.tags, v.tag_examples, v.markets))
query(
    "apply_decisions",
    """SELECT tag_id, market_id FROM market_tags g WHERE NOT EXISTS (SELECT 1 FROM history h
 WHERE h.tag_id = g.tag_id AND h.market_id = g.market_id AND NOT coalesce(human_decision, consensus)) UNION SELECT tag_id, market_id
 FROM history WHERE coalesce(human_decision, consensus)""",
)(lambda v: t.apply_decisions(v.market_tags, v.history))
OVERRIDDEN = """SELECT tag_id, market_id, yes, no, consensus, CASE WHEN market_id % 5 = 0 THEN FALSE ELSE human_decision END AS human_decision,
 CASE WHEN market_id % 5 <> 0 THEN decided_by WHEN human_decision IS NULL AND market_id % 3 <> 0 THEN 'human' ELSE 'human_correction' END AS decided_by,
 CASE WHEN market_id % 15 = 0 THEN updated_at + INTERVAL '41' HOUR WHEN market_id % 5 = 0 THEN updated_at + INTERVAL '36' HOUR ELSE updated_at END AS updated_at FROM history"""
query("human_overrides", OVERRIDDEN)(lambda v: t.human_overrides(v.history, decisions(v)))
query(
    "judge_history_after_overrides",
    f"""WITH {HIST.replace("FROM history", f"FROM ({OVERRIDDEN}) o")} SELECT x.tag_id, x.market_id, decision, source, position, m.question FROM (SELECT *, row_number() OVER (PARTITION BY tag_id
 ORDER BY updated_at DESC, market_id DESC) AS position FROM h) x LEFT JOIN markets m ON x.market_id = m.market_id WHERE position <= 20""",
)(lambda v: t.judge_history(t.human_overrides(v.history, decisions(v)), v.markets))
query(
    "tag_updates",
    """SELECT tag_id, CASE WHEN tag_id % 2 = 0 THEN upper(name) ELSE name END AS name, CASE WHEN tag_id % 2 = 0 THEN tag_id > 10 ELSE is_active END AS is_active, description
 FROM tags""",
)(
    lambda v: t.partial_update(
        v.tags.select("tag_id", "name", "is_active", "description"), v.tags.where("tag_id % 2 = 0").selectExpr("tag_id", "upper(name) AS name", "tag_id > 10 AS is_active", "cast(null as string) AS description"), "tag_id"
    )
)
query(
    "classification_batch",
    f"""WITH {NEXT} SELECT g.tag_id, coalesce(b.batch, []) AS batch, b.batch IS NULL AS exhausted FROM tags g LEFT JOIN (SELECT tag_id, list(market_id ORDER BY market_id) AS batch FROM nxt GROUP BY tag_id) b ON g.tag_id = b.tag_id
 WHERE g.is_active AND NOT g.all_checked AND g.tag_id IN (SELECT tag_id FROM tag_examples GROUP BY tag_id HAVING count(*) >= 2)""",
)(lambda v: t.classification_batch(v.tags, nxt(v), v.tag_examples))
query(
    "history_metrics",
    """SELECT count(*) AS total, count(consensus) AS llm, count(human_decision) AS human, count(CASE WHEN consensus IS NULL AND human_decision IS NULL THEN 1 END) AS pending
 FROM history""",
)(lambda v: t.history_metrics(v.history))
query(
    "judge_agreement",
    f"""WITH {VOTES} SELECT model, count(*) AS votes, count(CASE WHEN vote = human_decision THEN 1 END)::DOUBLE / count(*)::DOUBLE AS agreement
 FROM votes v JOIN history h ON v.tag_id = h.tag_id AND v.market_id = h.market_id WHERE vote IS NOT NULL AND human_decision IS NOT NULL
 GROUP BY model""",
)(lambda v: t.judge_agreement(v.judge_responses, v.history))
query(
    "tag_cascade_delete",
    """SELECT 'tags' AS name, count(*) AS rows FROM tags WHERE tag_id <> 3 UNION ALL SELECT 'market_tags', count(*) FROM market_tags
 WHERE tag_id <> 3 UNION ALL SELECT 'history', count(*) FROM history WHERE tag_id <> 3 UNION ALL SELECT 'tag_examples', count(*)
 FROM tag_examples WHERE tag_id <> 3""",
)(lambda v: _counts(t.cascade_delete(3, tags=v.tags, market_tags=v.market_tags, history=v.history, tag_examples=v.tag_examples)))
query(
    "example_upsert",
    """SELECT tag_id, market_id, CASE WHEN market_id % 4 = 0 THEN FALSE ELSE is_positive END AS is_positive FROM tag_examples UNION ALL
 SELECT 99 AS tag_id, market_id, TRUE FROM tag_examples WHERE market_id % 4 = 1""",
)(lambda v: _example_upsert(v))


def _counts(tables):
    from tallyforge.sources.scans import table_counts

    return table_counts(tables)


def _example_upsert(v):
    from tallyforge.sources.sinks import latest_by_key

    old = v.tag_examples.selectExpr("tag_id", "market_id", "is_positive", "0 AS version")
    new = v.tag_examples.where("market_id % 4 = 0").selectExpr("tag_id", "market_id", "false AS is_positive", "1 AS version")
    added = v.tag_examples.where("market_id % 4 = 1").selectExpr("99 AS tag_id", "market_id", "true AS is_positive", "1 AS version")
    return latest_by_key(old.unionByName(new).unionByName(added), ["tag_id", "market_id"], ["version"]).drop("version")
