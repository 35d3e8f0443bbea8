"""The operators as queries over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from silverline.llm import alignment, decontamination, lines, mixing, quality, runs, secrets, sharding, simhash, substrings, toolcalls, toxicity, urls
from silverline.llm.common import LAST_ID, table, words

#: Rules of the URL query.
URL_RULES = (
    urls.Rule("net", "/", "block"),
    urls.Rule("example.net", "/en/", "allow"),
    urls.Rule("example.com", "/de/", "block"),
    urls.Rule("org", "/fr/", "allow"),
)
#: Folder with the public vocabulary files.
TOKENIZERS = "/opt/tokenizers"
#: A text whose score reaches this is predicted to be toxic.
TOXIC = 0.7
#: Tools of the chat query: its calls are derived from the turns of conversations.
TOOLS = {
    "reply": {
        "type": "object",
        "properties": {"text": {"type": "string", "minLength": 1, "maxLength": 400}, "turn": {"type": "integer", "minimum": 0}},
        "required": ["text", "turn"],
        "additionalProperties": False,
    },
    "configure": {
        "type": "object",
        "properties": {"text": {"type": "string", "maxLength": 300}, "turn": {"type": "integer", "maximum": 0}},
        "required": ["text"],
    },
}


def op1_secret_scan(spark, sf_dir):
    """Long tokens of all documents that the forest takes for secrets.

    Findings are labelled from the documents themselves: 1 for forty hexadecimal digits assigned to a token, 0 for candidates of letters
    alone and parts of mail addresses; all others are left to the forest.
    """
    docs = table(spark, sf_dir, "documents")
    found = secrets.materialise(secrets.candidates(docs), "candidates")
    known = secrets.dictionary(docs)
    assigned = F.concat_ws(" ", "before2", "before").rlike("(?i)token =$")
    label = F.when(F.col("candidate").rlike("^[0-9a-f]{40}$") & assigned, 1).when(
        F.col("candidate").rlike("^[A-Za-z]+$") | F.col("mail"), 0
    )
    model = secrets.fit(found.withColumn("label", label), known)
    scored = secrets.scan(found, known, model).where("secret")
    return scored.select(F.col("id").alias("doc_id"), F.col("word").cast("long").alias("word"), F.col("place").cast("long").alias("place"), "candidate", "score")


def op2_sharding(spark, sf_dir):
    """24 shards of near equal bytes."""
    placed = sharding.kd_tree_shards(table(spark, sf_dir, "documents"), leaves=24)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_decontamination(spark, sf_dir):
    found = decontamination.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "whole.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op4_simhash(spark, sf_dir):
    grouped = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=3)
    known = lambda c: F.when(F.col(c) != LAST_ID, F.col(c))
    return grouped.select(
        known("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        known("component").alias("component_id"),
    )


def _tool_calls(spark, sf_dir):
    """Calls derived from conversations: a system turn configures, a user turn asks for a reply and needs the reply to the
    user turn two turns before; the assistant turn that follows holds the result.

    Turns whose conversation or number is missing have no id: each stays a row of its own, and nothing is linked to it.
    """
    turns = table(spark, sf_dir, "conversations")
    number = lambda shift: F.concat(F.lit("call_"), F.col("turn") + shift)
    known = lambda c: F.when(F.col("conv_id").isNotNull(), c)
    user = F.col("role") == "user"
    calls = turns.where(user | (F.col("role") == "system")).select(
        "conv_id",
        "turn",
        known(number(0)).alias("call_id"),
        F.when(user, "reply").otherwise("configure").alias("name"),
        F.to_json(F.struct("turn", "text")).alias("arguments"),
        F.when(user & (F.col("turn") >= 2), number(-2)).alias("after"),
    )
    results = turns.where(F.col("role") == "assistant").select(
        "conv_id", "turn", known(number(-1)).alias("call_id"), F.col("text").alias("content")
    )
    linked, unlinked = toolcalls.link_tool_calls(calls, results, TOOLS)
    # The id that the turn gives, also where the conversation is missing; quotes within texts are escaped, so only the line's own id is met.
    name = F.concat(F.lit('"id":"'), number(0), F.lit('","name":'))
    line = F.when(number(0).isNull(), F.col("line")).otherwise(F.replace("line", F.lit('"id":null,"name":'), name))
    return linked.withColumns({"line": line, "call_id": number(0)}), unlinked.withColumn("call_id", number(-1))


def op5_tool_calls(spark, sf_dir):
    """All calls in order, linked with their results."""
    return _tool_calls(spark, sf_dir)[0].select(
        "conv_id", "call_id", "turn", "name", "after", "depth", "position", "n_results",
        F.array_join("errors", "; ").alias("errors"), "valid", "line",
    )


def op5_tool_call_rows(spark, sf_dir):
    """What becomes of the rows behind `op5_tool_calls`: each call with the rows it stands for, and each result without a call."""
    linked, unlinked = _tool_calls(spark, sf_dir)
    no_number, no_text = F.lit(None).cast("long"), F.lit(None).cast("string")
    calls = linked.select(F.lit("call").alias("kind"), "conv_id", "call_id", "turn", "n_calls", "n_results", no_text.alias("content"))
    return calls.union(
        unlinked.select(
            F.lit("unlinked result"), "conv_id", "call_id", "turn", no_number.alias("n_calls"), no_number.alias("n_results"), "content"
        )
    )


def op6_line_dedup(spark, sf_dir):
    kept = lines.dedup_lines(table(spark, sf_dir, "documents"), min_chars=40, min_docs=5)
    return kept.select("whole.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op7_substring_dedup(spark, sf_dir):
    kept = substrings.dedup_substrings(table(spark, sf_dir, "documents"), window=50)
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["word"])
    return kept.select("whole.doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    judged = quality.judge(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return judged.select(
        "whole.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op9_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    judged = urls.judge_urls(pages, URL_RULES, urls.fit(pages, URL_RULES))
    return judged.select("whole.page_id", "host", "path", "rule", "verdict")


def op10_mixing(spark, sf_dir):
    mixed, _ = mixing.mix_sources(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, limit=2.0)
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op11_toxicity(spark, sf_dir):
    """Labels are learned from ids whose checksum leaves 0 or 2 when divided by 3; a missing id is held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    known = labels.where(remainder != 1).select(F.col("doc_id").alias("id"), F.col("toxic").alias("label"))
    scored = toxicity.score_toxicity(spark, docs, known).select("kept.doc_id", "score", "evidence")
    return scored.select(
        "doc_id",
        F.coalesce(remainder == 1, F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC).cast("int").alias("predicted"),
        "evidence",
    )


def _with_planted_runs(docs):
    """Every tenth id (by checksum) repeats its words from some place on."""
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(number / 10)

    def planted(w):
        n = F.size(w).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + g % 8))
        again = F.transform(F.sequence(F.lit(0).cast("long"), n - a - 1), lambda i: F.get(w, (a + i % p).cast("int")))
        return F.array_join(F.concat(F.slice(w, F.lit(1), a.cast("int")), again), " ")

    repeated = F.transform(F.array(words(F.col("text"))), lambda w: F.when(F.size(w) > 0, planted(w)).otherwise(""))[0]
    return docs.select("doc_id", F.when(number % 10 == 0, repeated).otherwise(F.col("text")).alias("text"))


def op12_runs(spark, sf_dir):
    found = runs.find_runs(_with_planted_runs(table(spark, sf_dir, "documents")), least=6, times=4)
    nothing = F.lit(None).cast("struct<start: long, length: long, period: long>")
    longer = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    best = F.aggregate("runs", nothing, lambda best, r: F.when(longer(best, r), r).otherwise(best))
    spelt = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    chosen = found.select("whole.doc_id", "runs", "kept", best.alias("best"))
    return chosen.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(spelt, 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )


def op13_alignment(spark, sf_dir, tokenizers=TOKENIZERS):
    a = alignment.ByteLevel.read(f"{tokenizers}/byte_bpe_50k.json")
    b = alignment.Pieces.read(f"{tokenizers}/piece_bpe_32k.model")
    aligned = alignment.align_tokenizers(spark, table(spark, sf_dir, "documents"), a, b, groups="sha256")
    counts = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    return aligned.select(F.col("kept.doc_id").cast("long").alias("doc_id"), *counts, F.col("groups").alias("groups_sha256"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_sharding,
        op3_decontamination,
        op4_simhash,
        op5_tool_calls,
        op5_tool_call_rows,
        op6_line_dedup,
        op7_substring_dedup,
        op8_quality_rules,
        op9_url_filter,
        op10_mixing,
        op11_toxicity,
        op12_runs,
        op13_alignment,
    )
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_ALNUM = (
    rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
_WINDOWS = "unnest(range(1, greatest(1, len(w) - 12) + 1))"

SQL = {
    "op3_decontamination": f"""
        with items as (select coalesce(cast(item_id as varchar), '') as item, {_ALNUM} as w from benchmark),
        places as (select item, w, {_WINDOWS} as i from items where len(w) > 0),
        windows as (select distinct item, w[i:i + 12] as x from places),
        sizes as (select distinct len(x) as n from windows),
        docs as (select doc_id, {_ALNUM} as w from documents),
        starts as (select doc_id, n, unnest(range(1, len(w) - n + 2)) as i, w from docs, sizes where len(w) >= n),
        hits as (select doc_id, n, i, item from starts join windows on w[i:i + n - 1] = x),
        hit as (select doc_id, count(*) as n_hit
            from (select distinct doc_id, unnest(range(i, i + n)) as word from hits) group by doc_id),
        found as (select doc_id, count(distinct item) as n_items,
            string_agg(distinct item, ',' order by item) as items from hits group by doc_id)
        select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
            coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
            coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
        from docs left join hit using (doc_id) left join found using (doc_id)""",
    "op5_tool_calls": """
        with calls as (select conv_id, turn, role, text, 'call_' || turn as call_id,
                case when role = 'user' then 'reply' else 'configure' end as name
            from conversations where role in ('user', 'system')),
        linked as (select c.*, p.call_id as after, c.role = 'user' and c.turn >= 2 and p.call_id is null as lost
            from calls c left join calls p on p.conv_id = c.conv_id and p.turn = c.turn - 2 and c.role = 'user'),
        chains as (select *, sum(case when after is null then 1 else 0 end) over (
            partition by conv_id, turn % 2 order by turn) as chain from linked),
        deep as (select *, row_number() over (partition by conv_id, turn % 2, chain order by turn) - 1 as depth from chains),
        placed as (select *, row_number() over (partition by conv_id order by depth, turn, call_id) - 1 as position from deep),
        answers as (select conv_id, turn - 1 as turn, text as result from conversations where role = 'assistant'),
        checked as (select p.*, result, result is not null as answered, list_filter([
                case when name = 'reply' and length(text) < 1 then 'text too short' end,
                case when name = 'reply' and length(text) > 400 then 'text too long' end,
                case when name = 'configure' and length(text) > 300 then 'text too long' end,
                case when name = 'configure' and p.turn > 0 then 'turn too large' end,
                case when lost then 'unknown after' end], lambda x: x is not null) as errors
            from placed p left join answers a on a.conv_id = p.conv_id and a.turn = p.turn)
        select conv_id, call_id, turn, name, after, depth::bigint as depth, position::bigint as position,
            answered::bigint as n_results, array_to_string(errors, '; ') as errors, len(errors) = 0 as valid,
            '{"after":' || coalesce(to_json(after)::varchar, 'null') || ',"arguments":{"text":' || to_json(text)::varchar
            || ',"turn":' || turn || '},"id":' || to_json(call_id)::varchar || ',"name":' || to_json(name)::varchar
            || ',"position":' || position || ',"result":' || coalesce(to_json(result)::varchar, 'null') || '}' as line
        from checked""",
    "op6_line_dedup": rf"""
        with split as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
            unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as i from documents),
        keyed as (select *, translate(trim(line, E' \t\n\x0B\f\r'), '{_UPPER}', '{_LOWER}') as k from split),
        common as (select k, max(doc_id) as last from keyed where length(k) >= 40
            group by k having count(distinct doc_id) >= 5),
        kept as (select s.*, last is not null and doc_id <> last as dropped from keyed s left join common using (k))
        select doc_id, count(*)::bigint as n_lines, count(*) filter (dropped)::bigint as n_dropped,
            sha256(coalesce(string_agg(line, chr(10) order by i) filter (not dropped), '')) as kept_sha256
        from kept group by doc_id""",
    "op7_substring_dedup": rf"""
        with docs as (select doc_id, {_WORDS} as w from documents),
        windows as (select doc_id, i, array_to_string(w[i:i + 49], ' ') as x
            from (select doc_id, w, unnest(range(1, len(w) - 48)) as i from docs)),
        firsts as (select x, min(doc_id) as first from windows group by x),
        gone as (select distinct doc_id, unnest(range(i, i + 50)) as i
            from windows join firsts using (x) where first < doc_id),
        words as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from docs),
        kept as (select s.doc_id, count(*) filter (g.i is not null) as n_removed,
            string_agg(word, ' ' order by s.i) filter (g.i is null) as kept
            from words s left join gone g on g.doc_id = s.doc_id and g.i = s.i group by s.doc_id)
        select doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed,
            sha256(coalesce(kept, '')) as kept_sha256 from docs left join kept using (doc_id)""",
}
SQL = {name: " ".join(sql.split()) for name, sql in SQL.items()}
