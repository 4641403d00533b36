"""Queries over the pipeline's operators, and the SQL that gives the same rows on the same tables.

All run over whole tables.  ``messages`` is reduced to one row per id; where the pipeline orders by time, the time
of loading (always present) stands for it; roles are as written, trimmed and in lower case.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions import textops as T
from threadloom.operators import datasets as D
from threadloom.operators import enrich as E
from threadloom.operators import normalize as N
from threadloom.operators import privacy as P
from threadloom.operators import threads as H
from threadloom.session import read_table
from threadloom.sources import chat_logs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _all(spark: SparkSession, d: str) -> DataFrame:
    return H.one_per_id(read_table(spark, d, "messages")).withColumn("speaker", F.lower(F.trim("speaker")))


def _base(spark: SparkSession, d: str) -> DataFrame:
    return _all(spark, d).where("conversation_id is not null")


BASE = """m as (select message_id, min(conversation_id) as conversation_id, min(source) as source, min(ordinal) as ordinal,
  lower(trim(min(speaker), ' ')) as speaker, min(text) as text, min(loaded_at) as ts from messages group by message_id having min(conversation_id) is not null)"""
EVERY = BASE.replace(" having min(conversation_id) is not null", "")
WORDS = "regexp_extract_all(lower({}), '[\\p{{L}}\\p{{N}}_]+')"


def _words(x: str) -> str:
    return WORDS.format(x)


def _lit(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _list(xs: list[str] | tuple[str, ...]) -> str:
    return "[" + ", ".join(_lit(x) for x in xs) + "]"


# --- conversations --------------------------------------------------------------------------------


@query(f"""with {BASE} select conversation_id, arg_min(source, (ts, ordinal, message_id)) as source, epoch_us(min(ts)) as start_us, epoch_us(max(ts)) as end_us,
  count(*) as n_messages from m where conversation_id <> '' group by conversation_id""")
def conversation_rollup(spark: SparkSession, d: str) -> DataFrame:
    r = H.rollup(_base(spark, d))
    return r.select("conversation_id", "source", F.unix_micros("start_ts").alias("start_us"), F.unix_micros("end_ts").alias("end_us"), "n_messages")


@query(f"""with {BASE}, p as (select conversation_id, count(*) as turns, sum(length(coalesce(text, ''))) as chars, sum(len({_words("coalesce(text, '')")})) as words from m group by 1)
select count(*) as conversations, sum(turns)::bigint as messages, min(turns) as min_turns, max(turns) as max_turns, sum(turns)::bigint as sum_turns,
 min(chars)::bigint as min_chars, max(chars)::bigint as max_chars, sum(chars)::bigint as sum_chars, min(words)::bigint as min_words, max(words)::bigint as max_words,
 sum(words)::bigint as sum_words, round_even(sum(words) * 1.3::double, 0)::bigint as estimated_tokens from p""")
def conversation_stats(spark: SparkSession, d: str) -> DataFrame:
    return D.statistics(_base(spark, d))


@query(f"with {BASE}, c as (select coalesce(speaker, 'none') as speaker, count(*) as n from m group by 1) select speaker, n, n / (sum(n) over ())::double as ratio from c")
def speaker_ratios(spark: SparkSession, d: str) -> DataFrame:
    c = _base(spark, d).groupBy(F.coalesce("speaker", F.lit("none")).alias("speaker")).agg(F.count("*").alias("n"))
    total = c.agg(F.sum("n").alias("total"))
    return c.crossJoin(F.broadcast(total)).select("speaker", "n", (F.col("n") / F.col("total")).alias("ratio"))  # a one-row total


@query(f"with w as (select unnest({_words('text')}) as w from documents where text is not null) select count(distinct w) as vocabulary_size, count(*) as n_words from w")
def vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return D.vocabulary_size(read_table(spark, d, "documents"))


@query(f"""select doc_type, round_even(sum(len({_words("coalesce(text, '')")})) * 1.3::double, 0)::bigint as tokens from documents group by doc_type""")
def token_estimate(spark: SparkSession, d: str) -> DataFrame:
    n = F.sum(F.size(T.words(F.coalesce("text", F.lit("")))))
    return read_table(spark, d, "documents").groupBy("doc_type").agg(T.token_estimate(n).alias("tokens"))


@query("select source, count(*) as n, count(*) / (sum(count(*)) over ())::double as share from conversation group by source")
def source_histogram(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "conversation").groupBy("source").agg(F.count("*").alias("n"))
    return c.crossJoin(F.broadcast(c.agg(F.sum("n").alias("t")))).select("source", "n", (F.col("n") / F.col("t")).alias("share"))  # a one-row total


@query("""select s.source, coalesce(n, 0) as n, 100.0::double * coalesce(n, 0) / (sum(coalesce(n, 0)) over ())::double as percent
from (values ('gmail'), ('whatsapp'), ('other')) s(source) left join (select source, count(*) as n from conversation group by 1) c on c.source = s.source""")
def source_percent(spark: SparkSession, d: str) -> DataFrame:
    return D.shares(read_table(spark, d, "conversation"), "source", ["gmail", "whatsapp", "other"])


# --- sessions and order ---------------------------------------------------------------------------


def _events(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "events").withColumn("s", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)


_SESSIONS = """g as (select event_id, user_id, ts, case when epoch_us(ts) - lag(epoch_us(ts)) over w > 86400000000 then 1 else 0 end as c from events window w as (partition by user_id order by ts, event_id)),
 s as (select event_id, user_id, ts, sum(c) over (partition by user_id order by ts, event_id)::bigint as session_index from g)"""


@query(f"with {_SESSIONS} select event_id, user_id::varchar || '_session_' || session_index::varchar as session_id from s")
def sessionize(spark: SparkSession, d: str) -> DataFrame:
    return H.sessionize(_events(spark, d), "user_id", F.col("s"), 86400, "event_id").select("event_id", "session_id")


@query(f"with {_SESSIONS} select user_id, max(session_index) + 1 as total_sessions from s group by user_id")
def session_summary(spark: SparkSession, d: str) -> DataFrame:
    return H.session_totals(H.sessionize(_events(spark, d), "user_id", F.col("s"), 86400, "event_id"), "user_id")


@query(f"with {_SESSIONS} select user_id, epoch_us(min(ts)) as start_us, epoch_us(max(ts)) as end_us, count(*) as n from s group by user_id, session_index")
def session_window_builtin(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d).withColumn("t", F.col("ts").cast("timestamp"))
    g = e.groupBy("user_id", F.session_window("t", "86400 seconds")).agg(F.min("t").alias("a"), F.max("t").alias("b"), F.count("*").alias("n"))
    return g.select("user_id", F.unix_micros("a").alias("start_us"), F.unix_micros("b").alias("end_us"), "n")


@query(f"""with {BASE}, o as (select conversation_id, message_id, epoch_us(ts) as us, last_value(epoch_us(ts) ignore nulls) over (partition by conversation_id order by ordinal, message_id rows between unbounded preceding and 1 preceding) as p from m)
select conversation_id, message_id, us - p as step_us from o where us < p""")
def order_violations(spark: SparkSession, d: str) -> DataFrame:
    m = _base(spark, d).select("conversation_id", "message_id", F.struct("ordinal", "message_id").alias("place"), F.unix_micros("ts").alias("us"))
    return H.order_violations(m, "conversation_id", "place", "us").select("conversation_id", "message_id", (F.col("us") - F.col("previous")).alias("step_us"))


_PARTS = f"""{BASE}, g as (select *, case when epoch_us(ts) - lag(epoch_us(ts)) over w > 86400000000 then 1 else 0 end as c from m window w as (partition by conversation_id order by ts, ordinal, message_id)),
 s as (select *, sum(c) over (partition by conversation_id order by ts, ordinal, message_id)::bigint as k from g)"""


@query(f"""with {_PARTS}, h as (select conversation_id as original, k, arg_min(source, (ts, ordinal, message_id)) as source, epoch_us(min(ts)) as start_us, epoch_us(max(ts)) as end_us, count(*) as n_messages from s group by 1, 2)
select original || '_session_' || k::varchar as conversation_id, source, k as session_index, max(k) over (partition by original) + 1 as total_sessions, start_us, end_us, n_messages from h
union all select conversation_id, source, null, null, null, null, 0 from conversation where conversation_id not in (select conversation_id from m)""")
def session_headers(spark: SparkSession, d: str) -> DataFrame:
    m = _base(spark, d)
    parts = H.sessionize(m, "conversation_id", F.unix_micros("ts") / 1e6, 86400, "ordinal", "message_id").withColumn("original_conversation_id", F.col("conversation_id"))
    heads = H.session_headers(parts.withColumn("conversation_id", F.col("session_id")))
    heads = heads.select(
        "conversation_id", "source", F.col("session_index").cast("long").alias("session_index"), F.col("total_sessions").cast("long").alias("total_sessions"),
        F.unix_micros("start_ts").alias("start_us"), F.unix_micros("end_ts").alias("end_us"), F.col("total_messages").alias("n_messages"),
    )
    empty = H.empty_headers(read_table(spark, d, "conversation"), m)
    none = F.lit(None).cast("long")
    return heads.unionByName(empty.select("conversation_id", "source", none.alias("session_index"), none.alias("total_sessions"), none.alias("start_us"), none.alias("end_us"), F.lit(0).cast("long").alias("n_messages")))


_STREAK = """i as (select *, case when speaker = lag(speaker) over w then 0 else 1 end as c from m where speaker in ('user', 'assistant') window w as (partition by conversation_id order by ts, ordinal, message_id)),
 j as (select *, sum(c) over (partition by conversation_id order by ts, ordinal, message_id) as island from i),
 k as (select *, row_number() over (partition by conversation_id, island order by ts, ordinal, message_id) as streak from j)"""


@query(f"with {BASE}, {_STREAK} select conversation_id, message_id, streak from k where streak > 3")
def speaker_streaks(spark: SparkSession, d: str) -> DataFrame:
    return H.streaks(_base(spark, d)).select("conversation_id", "message_id", F.col("streak").cast("long").alias("streak"))


_BLANK = "trim(coalesce(text, ''), e' \\t\\n\\r') = ''"


@query(f"""with {BASE}, {_STREAK}, o as (select *, max(ts) over (partition by conversation_id order by ordinal, message_id rows between unbounded preceding and 1 preceding) as mx,
  lag(ts) over (partition by conversation_id order by ordinal, message_id) as p from m)
select (select count(distinct conversation_id) from m) as conversations, (select sum(coalesce((ts < p)::int, 0) + (speaker is null or speaker not in ('user', 'assistant'))::int + ({_BLANK})::int) from o)::bigint as errors,
  (select count(*) from k where streak > 3) as warnings, 'FAIL' as status""")
def validation_report(spark: SparkSession, d: str) -> DataFrame:
    return H.validation_report(_base(spark, d))


# --- scrubbing ------------------------------------------------------------------------------------

def _scrub(name: str, f: Callable, pattern: str, sql: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        m = _all(spark, d).where(F.col("text").isNotNull())
        return m.select("message_id", F.regexp_count("text", F.lit(pattern)).cast("long").alias("hits"), F.md5(f(F.col("text"))).alias("digest")).where("hits > 0")

    run.__name__ = name
    query(sql)(run)


# RE2 has no look-behind: what may not precede a place code is matched and put back.
_PLACE_SQL = rf"(?i)(^|[^\p{{L}}\p{{N}}_])(?:{T.STREET.replace(chr(92) + 'b', '', 1)})|(^|[^\p{{L}}\p{{N}}_#$€£])[0-9]{{5}}(?:-[0-9]{{4}})?\b"


def _swap(x: str, pattern: str, new: str) -> str:
    return f"regexp_replace({x}, {_lit(pattern)}, {_lit(new)}, 'g')"


def _count(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, {_lit(pattern)}))::bigint"


def _secrets(x: str) -> str:
    """The three steps of the credential rule."""
    marked = f"regexp_replace({x}, {_lit(T.CREDENTIAL)}, '\\1' || chr(1) || '\\2' || chr(2) || '[PASSWORD]', 'g')"
    return f"regexp_replace(regexp_replace({marked}, chr(1) || '\\s*=\\s*' || chr(2), ': ', 'g'), '[' || chr(1) || chr(2) || ']', '', 'g')"


def _mail(x: str) -> str:
    return _swap(x, T.EMAIL, "[EMAIL]")


def _number(x: str) -> str:
    return _swap(x, T.PHONE, "[PHONE]")


#: Letters beyond ASCII, which RE2 takes for the end of a word; a mark before each keeps the word together.
_LETTERS = "([\\x{aa}\\x{b5}\\x{ba}\\x{c0}-\\x{d6}\\x{d8}-\\x{f6}\\x{f8}-\\x{24f}\\x{370}-\\x{1fff}\\x{2c00}-\\x{2dff}\\x{a640}-\\x{abff}])"


def _joined(x: str) -> str:
    return f"regexp_replace({x}, '{_LETTERS}', '_' || chr(3) || '\\1', 'g')"


def _place(x: str) -> str:
    return f"replace({_swap(_joined(x), _PLACE_SQL, chr(92) + '1' + chr(92) + '2[ADDRESS]')}, '_' || chr(3), '')"


def _scrub_sql(count: str, new: str) -> str:
    return f"with {EVERY}, t as (select message_id, {count} as hits, md5({new}) as digest from m where text is not null) select * from t where hits > 0"


_scrub("scrub_email", T.scrub_email, T.EMAIL, _scrub_sql(_count("text", T.EMAIL), _mail("text")))
_scrub("scrub_phone", T.scrub_phone, T.PHONE, _scrub_sql(_count("text", T.PHONE), _number("text")))
_scrub("scrub_address", T.scrub_address, T.ADDRESS, _scrub_sql(_count(_joined("text"), _PLACE_SQL), _place("text")))


_FORMS = "(values ('my password is: Abc#12'), ('PIN = 4711 and key: x_1'), ('pin = key: x'), ('secret key to= k-9; pass: 1'), ('no secret here'), (''))"


@query(f"""with {EVERY}, t as (select message_id, text from m where text is not null union all select 'form ' || f.x, f.x from {_FORMS} f(x))
select message_id, {_count("text", T.CREDENTIAL)} as hits, {_secrets("text")} as scrubbed from t where {_count("text", T.CREDENTIAL)} > 0""")
def scrub_credentials(spark: SparkSession, d: str) -> DataFrame:
    """The messages and a few given forms, since hardly any message tells a credential."""
    forms = ["my password is: Abc#12", "PIN = 4711 and key: x_1", "pin = key: x", "secret key to= k-9; pass: 1", "no secret here", ""]
    given = spark.createDataFrame([(f"form {x}", x) for x in forms], "message_id string, text string")
    rows = _all(spark, d).where("text is not null").select("message_id", "text").unionByName(given)
    return rows.select("message_id", F.regexp_count("text", F.lit(T.CREDENTIAL)).cast("long").alias("hits"), T.scrub_credentials(F.col("text")).alias("scrubbed")).where("hits > 0")


_CHAIN = f"""a as (select *, {_count("t", T.EMAIL)} as emails, {_mail("t")} as t1 from (select *, coalesce(text, '') as t from m)),
 b as (select *, {_count("t1", T.PHONE)} as phones, {_number("t1")} as t2 from a), c as (select *, {_count(_joined("t2"), _PLACE_SQL)} as addresses, {_place("t2")} as t3 from b),
 e as (select *, {_count("t3", T.CREDENTIAL)} as passwords, {_secrets("t3")} as t4 from c)"""


def _counted(spark: SparkSession, d: str) -> DataFrame:
    """Replacements by conversation; no message's name counts, so SQL can follow."""
    none = spark.createDataFrame([], "conversation_id string, names array<string>")
    return P.counts(P.scrubbed(_base(spark, d), none))


_COUNTED = f"with {BASE}, {_CHAIN}, p as (select conversation_id, sum(emails)::bigint as emails, sum(phones)::bigint as phones, sum(addresses)::bigint as addresses, sum(passwords)::bigint as passwords, 0::bigint as names, 0::bigint as nsfw, 0::bigint as private from e group by 1)"


@query(f"{_COUNTED} select count(*) as conversations, sum(emails)::bigint as emails, sum(phones)::bigint as phones, sum(addresses)::bigint as addresses, sum(passwords)::bigint as passwords, 0::bigint as names, 0::bigint as nsfw, 0::bigint as private from p")
def privacy_totals(spark: SparkSession, d: str) -> DataFrame:
    return P.totals(_counted(spark, d))


@query(f"{_COUNTED} select * from p where emails + phones + addresses + passwords > 0")
def privacy_details(spark: SparkSession, d: str) -> DataFrame:
    return P.details(_counted(spark, d))


@query(f"with {BASE}, {_CHAIN} select message_id, t4 as text from e where text is not null")
def scrub_pipeline(spark: SparkSession, d: str) -> DataFrame:
    return _base(spark, d).where(F.col("text").isNotNull()).select("message_id", T.scrub(F.col("text")).alias("text"))


@query("""select message_id, case when decided then 'was ' || length(text)::varchar else text end as text, decided::int::bigint as private from
 (select message_id, coalesce(min(text), '') as text, coalesce(length(min(text)) % 3 = 0, false) as decided from messages group by 1)""")
def scrub_decisions(spark: SparkSession, d: str) -> DataFrame:
    """Decisions of a stand-in for a model: every text of a length divisible by three is private."""
    m = _all(spark, d).withColumn("text", F.coalesce("text", F.lit(""))).withColumn("had", F.col("text") != "")

    class Third:
        def scrub(self, messages: list[dict]) -> list[dict]:
            return [{"message_id": x["message_id"], "is_private": True, "scrubbed_text": f"was {len(x['text'])}"} for x in messages if len(x["text"]) % 3 == 0 and x["text"] is not None]

    known = H.one_per_id(read_table(spark, d, "messages")).where("text is not null").select("message_id")
    asked = m.join(known, "message_id", "left_semi")
    return P.decided(m, E.decisions(asked, Third)).select("message_id", "text", "private")


@query()
def scrub_names(spark: SparkSession, d: str) -> DataFrame:
    m = read_table(spark, d, "messages").where("text is not null").dropDuplicates(["message_id"])
    who = F.regexp_replace(F.regexp_replace(F.col("metadata")["raw_speaker_name"], r"<.*$", ""), r'["~]', "")
    names = F.when(who.rlike(r"^\+?[\d\s\-()]+$") | who.isNull(), F.array().cast("array<string>")).otherwise(F.array_union(F.array(F.trim(who)), F.split(F.trim(who), r"[\s,]+")))
    return m.select("message_id", T.scrub_names(F.col("text"), names).alias("text"))


# --- cleaning -------------------------------------------------------------------------------------

_AUTO = "(" + " or ".join(f"contains(lower(text), {_lit(k)})" for k in T.AUTOREPLY) + ")"
_LOW = f"regexp_replace(regexp_replace(trim(lower(text), e' \\t\\n\\r'), '^\\.+|\\.+$', '', 'g'), '^!+|!+$', '', 'g') in ({', '.join(map(_lit, T.LOW_QUALITY))})"


@query(f"with {BASE} select message_id from m where text is not null and not {_AUTO}")
def drop_autoreply(spark: SparkSession, d: str) -> DataFrame:
    return _base(spark, d).where(F.col("text").isNotNull() & ~T.is_autoreply(F.col("text"))).select("message_id")


@query(f"with {BASE} select message_id from m where text is not null and not ({_LOW})")
def drop_low_quality(spark: SparkSession, d: str) -> DataFrame:
    return _base(spark, d).where(F.col("text").isNotNull() & ~T.is_low_quality(F.col("text"))).select("message_id")


_ENDS = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}]"
_WHITE = "[\\s\\x0b\\x1c-\\x1f\\x{85}\\x{a0}]+"


def _bare(x: str) -> str:
    return f"regexp_replace({x}, '^{_WHITE}|{_WHITE}$', '', 'g')"


_KIND = " ".join([f"case when {_bare('x')} = '' then 's'", *[f"when regexp_matches({_bare('x')}, {_lit(p)}) then 'm'" for p in T.SIGNATURE], f"when length({_bare('x')}) < 20 then 's' else 'b' end"])
#: The text of each message without its signature, as ``z``.
_SIGNED = f"""l as (select *, string_split_regex(regexp_replace(coalesce(text, ''), '(?:{_ENDS})\\z', ''), '{_ENDS}') as ls from m),
 k as (select *, list_transform(ls, lambda x: {_KIND}) as ks from l),
 q as (select *, case when list_contains(ks, 'b') then len(ks) - list_position(list_reverse(ks), 'b') + 1 else 0 end as b from k),
 r as (select *, case when list_contains(ks[b + 1:], 'm') then b + list_position(ks[b + 1:], 'm') - 1 else len(ks) end as cut from q),
 z as (select *, {_bare("array_to_string(ls[1:cut], chr(10))")} as z from r)"""
_CLEANED = f"""{_SIGNED}, v as (select conversation_id, message_id, ts, ordinal, speaker, z from z where not ({_AUTO.replace("lower(text)", "lower(coalesce(text, ''))")}) and not ({_LOW.replace("lower(text)", "lower(z)")}) and z <> ''),
 w as (select *, row(speaker, z) is not distinct from lag(row(speaker, z)) over (partition by conversation_id order by ts, ordinal, message_id) as same from v), y as (select * from w where same is not true)"""


@query(f"with {BASE}, {_CLEANED} select message_id from y")
def drop_consecutive_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """The messages that cleaning keeps: the rule looks at cleaned texts of messages that no other rule drops."""
    return H.clean(_base(spark, d)).select("message_id")


@query(f"with {BASE}, {_SIGNED} select message_id, z as text from z where text is not null and source = 'gmail'")
def strip_signatures(spark: SparkSession, d: str) -> DataFrame:
    return _base(spark, d).where("text is not null and source = 'gmail'").select("message_id", T.strip_signatures(F.col("text")).alias("text"))


@query(f"""with {BASE}, {_CLEANED}, t as (select conversation_id, count(*) as total from m group by 1), a as (select conversation_id, count(*) as kept, epoch_us(min(ts)) as start_us, epoch_us(max(ts)) as end_us from y group by 1)
select conversation_id, coalesce(kept, 0) as kept, total - coalesce(kept, 0) as removed, start_us, end_us from t left join a using (conversation_id)""")
def clean_counts(spark: SparkSession, d: str) -> DataFrame:
    m = _base(spark, d)
    h = H.cleaned_headers(m, H.clean(m))
    return h.select("conversation_id", "kept", "removed", F.unix_micros("start_ts").alias("start_us"), F.unix_micros("end_ts").alias("end_us"))


# --- annotation -----------------------------------------------------------------------------------


def _any(needles: list[str]) -> str:
    return "(" + " or ".join(f"contains(low, {_lit(n)})" for n in needles) + ")"


_INTENT = (
    "case when coalesce(speaker, 'user') = 'user' then case "
    + " ".join(f"when {_any(n)} then {_lit(k)}" for k, n in T.USER_INTENTS.items())
    + " else 'technical_support' end else case "
    + " ".join(f"when {_any(n)} then {_lit(k)}" for k, n in T.ASSISTANT_INTENTS.items())
    + " else 'provide_information' end end"
)
_LOWERED = f"{BASE}, t as (select *, lower(coalesce(text, '')) as low from m)"


@query(f"with {_LOWERED} select message_id, {_INTENT} as label from t")
def intent_labels(spark: SparkSession, d: str) -> DataFrame:
    return D.annotate(_base(spark, d)).select("message_id", "label")


_BALANCE = f"len(list_filter({_words('low')}, lambda x: x in ({', '.join(map(_lit, T.POSITIVE))}))) + contains(low, '👍')::int - len(list_filter({_words('low')}, lambda x: x in ({', '.join(map(_lit, T.NEGATIVE))})))"


@query(f"with {_LOWERED}, b as (select message_id, {_BALANCE} as b from t) select message_id, case when b > 0 then 'positive' when b < 0 then 'negative' else 'neutral' end as sentiment, case when b = 0 then 0.5::double else 0.8::double end as score from b")
def sentiment_labels(spark: SparkSession, d: str) -> DataFrame:
    return D.annotate(_base(spark, d)).select("message_id", "sentiment", "score")


@query(f"""with {_LOWERED}, a as (select *, {_INTENT} as label from t)
select conversation_id, case when bool_or({_any(["billing", "charge"])}) then 'Customer raised billing inquiry regarding incorrect/double charge.'
 when bool_or({_any(["order", "track"])}) then 'Customer requested order status or shipping details update.' else 'Customer query/inquiry regarding services.' end as issue,
 case when bool_or(label = 'execute_action') then 'Agent executed customer request successfully.' when bool_or(label = 'request_details') then 'Agent requested details to verify identity/account.'
 else 'Agent provided assistance.' end as resolution from a group by conversation_id""")
def summaries(spark: SparkSession, d: str) -> DataFrame:
    return D.summaries(D.annotate(_base(spark, d)))


def _languages_sql() -> str:
    scripts = {"ta": "஀-௿", "hi": "ऀ-ॿ", "gu": "઀-૿", "bn": "ঀ-৿", "te": "ఀ-౿", "kn": "ಀ-೿", "ml": "ഀ-ൿ"}
    found = [f"case when regexp_matches(coalesce(text, ''), '[{scripts[k[:2]]}]') then {_lit(k)} end" for k in T.SCRIPTS]
    found += [f"case when len(list_intersect(ws, {_list(w)})) >= {n} then {_lit(k)} end" for k, (n, w) in T.ROMANISED.items()]
    some = f"list_distinct(list_filter([{', '.join(found)}], lambda x: x is not null))"
    return f"""with {_LOWERED}, w as (select *, list_distinct({_words('low')}) as ws from t), s as (select *, {some} as hits from w)
select message_id, array_to_string(list_sort(case when len(hits) = 0 then case when regexp_matches(coalesce(text, ''), '[^\\x00-\\x7f]') then [{_lit(T.NO_LANGUAGE)}] else [{_lit(T.ENGLISH_LABEL)}] end
 when len(list_intersect(ws, {_list(T.ENGLISH)})) > 0 then list_distinct(list_concat(hits, [{_lit(T.ENGLISH_LABEL)}])) else hits end), '|') as languages from s"""


@query(_languages_sql())
def languages(spark: SparkSession, d: str) -> DataFrame:
    return D.annotate(_base(spark, d)).select("message_id", F.array_join("languages", "|").alias("languages"))


_UNION = "u as (select conversation_id, unnest(d.languages) as l from (select conversation_id, unnest(detected_languages) as d from language_annotations))"


@query(f"with {_UNION} select l as language, count(distinct conversation_id) as n from u where l is not null group by l union all select 'All', count(distinct conversation_id) from u where l is not null")
def language_counts(spark: SparkSession, d: str) -> DataFrame:
    found = D.conversation_languages(read_table(spark, d, "language_annotations")).where(F.size("languages") > 0)
    each = found.select("conversation_id", F.explode("languages").alias("language")).groupBy("language").agg(F.count("*").alias("n"))
    return each.unionByName(found.agg(F.lit("All").alias("language"), F.count("*").alias("n")))


@query("""with e as (select conversation_id, unnest(detected_languages) as d from language_annotations)
select conversation_id, d.message_id as message_id, array_to_string(list_transform(d.languages, lambda x: case when x = 'pt - Portuguese' then 'es - Spanish' else x end), '|') as languages
from e where list_contains(d.languages, 'pt - Portuguese')""")
def language_remap(spark: SparkSession, d: str) -> DataFrame:
    a = read_table(spark, d, "language_annotations")
    had = a.select("conversation_id", F.explode("detected_languages").alias("d")).where(F.array_contains("d.languages", "pt - Portuguese")).select("conversation_id", "d.message_id")
    new = D.remap_language(a, "pt - Portuguese", "es - Spanish").select("conversation_id", F.explode("detected_languages").alias("d"))
    new = new.select("conversation_id", "d.message_id", F.array_join("d.languages", "|").alias("languages"))
    return new.join(had.distinct(), ["conversation_id", "message_id"])


# --- gates and coverage ---------------------------------------------------------------------------

_WITH_CUSTOMER = "select conversation_id from conversation where metadata.customer_name is not null"


def _named(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "conversation").where("metadata.customer_name is not null").select("conversation_id")


@query(f"with {EVERY} select message_id from m where conversation_id is null or conversation_id in ({_WITH_CUSTOMER})")
def listed_only(spark: SparkSession, d: str) -> DataFrame:
    return D.only(_all(spark, d), _named(spark, d)).select("message_id")


@query(f"with {EVERY} select message_id from m where conversation_id is null or conversation_id not in ({_WITH_CUSTOMER})")
def unlisted_only(spark: SparkSession, d: str) -> DataFrame:
    return D.without(_all(spark, d), _named(spark, d)).select("message_id")


@query(f"with {_UNION} select conversation_id from conversation where conversation_id not in (select conversation_id from u where l is not null and l not in ({', '.join(map(_lit, D.DEFAULT_LANGUAGES))}))")
def language_gate(spark: SparkSession, d: str) -> DataFrame:
    return D.language_gate(read_table(spark, d, "conversation"), read_table(spark, d, "language_annotations")).select("conversation_id")


_ANNOTATED = "select conversation_id, unnest(detected_languages).message_id as message_id from language_annotations"


@query(f"""with {BASE}, h as (select conversation_id, count(distinct message_id) as have from ({_ANNOTATED}) group by 1), w as (select conversation_id, count(*) as want from m group by 1)
select conversation_id, want, coalesce(have, 0) as have from w left join h using (conversation_id) where coalesce(have, 0) < want""")
def annotation_cache_miss(spark: SparkSession, d: str) -> DataFrame:
    a = read_table(spark, d, "language_annotations").select("conversation_id", F.explode("detected_languages").alias("d")).select("conversation_id", "d.message_id")
    return D.incomplete(_base(spark, d), a)


_HAVE = "(select conversation_id, unnest(detected_languages) as d from language_annotations)"


@query(f"""with o as (select 'languages' as output, conversation_id from language_annotations union select 'labelled', conversation_id from {_HAVE} where len(d.languages) > 0
 union select 'english', conversation_id from {_HAVE} where list_contains(d.languages, 'en - English') union select 'messages', conversation_id from messages)
select output, (select count(distinct conversation_id) from conversation) - count(distinct conversation_id) as missing, (select count(distinct conversation_id) from conversation) as total
from o where conversation_id in (select conversation_id from conversation) group by output""")
def annotation_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Conversations that lack each of four outputs (here tables that stand for them)."""
    a = read_table(spark, d, "language_annotations")
    one = a.select("conversation_id", F.explode("detected_languages").alias("d"))
    outputs = {"languages": a, "labelled": one.where(F.size("d.languages") > 0), "english": one.where(F.array_contains("d.languages", "en - English")), "messages": read_table(spark, d, "messages")}
    return D.coverage(read_table(spark, d, "conversation"), **outputs)


_MESSAGES_OF = "(select d.message_id as message_id, max(d.languages) as languages from (select unnest(detected_languages) as d from language_annotations) where d.message_id is not null group by 1)"


@query(f"with {BASE} select m.message_id, array_to_string(case when len(languages) > 0 then languages else ['en - English'] end, '|') as languages from m left join {_MESSAGES_OF} a using (message_id)")
def message_languages(spark: SparkSession, d: str) -> DataFrame:
    found = D.message_languages(_base(spark, d), read_table(spark, d, "language_annotations"))
    return found.select("message_id", F.array_join("languages", "|").alias("languages"))


@query(f"""with {_UNION}, f as (select conversation_id, list_sort(list_distinct(list(l) filter (l not in ({', '.join(map(_lit, D.DEFAULT_LANGUAGES))})))) as flags from u where l is not null group by 1)
select conversation_id, case when metadata.customer_name is not null then 'approved' when len(flags) > 0 then 'flagged' else 'pending' end as status, coalesce(array_to_string(flags, '|'), '') as flags from conversation left join f using (conversation_id)""")
def review_status(spark: SparkSession, d: str) -> DataFrame:
    r = D.review_status(read_table(spark, d, "conversation"), _named(spark, d), read_table(spark, d, "language_annotations"))
    return r.select("conversation_id", "status", F.array_join("flags", "|").alias("flags"))


@query(f"""with {BASE}, w as (select conversation_id, count(*) as want from m group by 1), l as (select conversation_id, count(*) as n from {_HAVE} group by 1), i as (select conversation_id, count(*) as n from m where speaker is not null group by 1),
 s as (select conversation_id, count(*) as n from m where text is not null group by 1)
select conversation_id from w left join l using (conversation_id) left join i using (conversation_id) left join s using (conversation_id)
where not coalesce(l.n = want and i.n = want and s.n = want and conversation_id in (select conversation_id from conversation), false)""")
def annotation_pending(spark: SparkSession, d: str) -> DataFrame:
    """Conversations with fewer rows than messages in some output (here tables that stand for the four)."""
    m = _base(spark, d)
    one = read_table(spark, d, "language_annotations").select("conversation_id", F.explode("detected_languages").alias("d"))
    return D.incomplete_outputs(m, m.where("speaker is not null"), m.where("text is not null"), read_table(spark, d, "conversation"), one)


@query(f"with {BASE} select conversation_id, md5(string_agg('[' || message_id || '] ' || upper(coalesce(speaker, 'user')) || ': ' || coalesce(text, ''), chr(10) order by ts, ordinal, message_id)) as digest, count(*) as n from m group by 1")
def prompt_lines(spark: SparkSession, d: str) -> DataFrame:
    line = F.array_sort(F.collect_list(F.struct("ts", "ordinal", "message_id", "line")))
    p = D.prompt_lines(_base(spark, d)).groupBy("conversation_id").agg(line.alias("p"), F.count("*").alias("n"))
    return p.select("conversation_id", F.md5(F.array_join(F.transform("p", lambda x: x["line"]), "\n")).alias("digest"), "n")


@query("""select 'conversations' as metric, count(distinct conversation_id) as n from language_annotations union all select 'labels', count(*) from (select unnest(d.languages) from (select unnest(detected_languages) as d from language_annotations))
union all select 'messages', count(*) from (select unnest(detected_languages) from language_annotations)""")
def annotation_counters(spark: SparkSession, d: str) -> DataFrame:
    a = read_table(spark, d, "language_annotations")
    one = a.select("conversation_id", F.explode("detected_languages").alias("d"))
    c = a.agg(F.countDistinct("conversation_id").alias("conversations")).crossJoin(one.agg(F.count("*").alias("messages"), F.sum(F.size(F.coalesce("d.languages", F.array()))).alias("labels")))  # one row each
    return c.unpivot([], ["conversations", "messages", "labels"], "metric", "n")


# --- exports --------------------------------------------------------------------------------------

_ORDERED = "order by ts, ordinal, message_id"


@query(f"""with {BASE} select conversation_id, count(*) as n, md5(string_agg(case when speaker in ('user', 'assistant', 'system') then speaker else 'user' end || ':' || coalesce(text, ''), chr(10) {_ORDERED})) as digest
from m group by conversation_id""")
def chat_export(spark: SparkSession, d: str) -> DataFrame:
    x = D.chat_examples(_base(spark, d))
    lines = F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"]))
    return x.select("conversation_id", F.size("messages").cast("long").alias("n"), F.md5(F.array_join(lines, "\n")).alias("digest"))


@query(f"""with {BASE}, t as (select *, row_number() over (partition by conversation_id {_ORDERED}) - 1 as turn, count(*) over (partition by conversation_id) as n from m),
 c as (select distinct conversation_id, n, unnest(generate_series(0, (n - 1) // 2)) as chunk from (select distinct conversation_id, n from t)),
 j as (select c.chunk, t.* from c join t on t.conversation_id = c.conversation_id and t.turn between c.chunk * 2 and c.chunk * 2 + 3)
select conversation_id || '_chunk_' || chunk::varchar as chunk_id, min(turn) as first_turn, max(turn) as last_turn, arg_min(message_id, turn) as start_message_id, arg_max(message_id, turn) as end_message_id,
 md5(string_agg(upper(substring(coalesce(speaker, 'user'), 1, 1)) || lower(substring(coalesce(speaker, 'user'), 2)) || ': ' || coalesce(text, ''), chr(10) order by turn)) as digest
from j group by conversation_id, chunk""")
def rag_segments(spark: SparkSession, d: str) -> DataFrame:
    s = D.segments(_base(spark, d))
    return s.select("chunk_id", "first_turn", "last_turn", "start_message_id", "end_message_id", F.md5("content").alias("digest"))


@query(f"""with {BASE}, n as (select conversation_id, count(*) as n from m group by 1)
select 'rag_segments' as metric, sum((n + 1) // 2)::bigint as n from n union all select 'conversations', count(*) from n
union all select 'rag_facts', sum((regexp_matches(text, '#[0-9]+'))::int + {" + ".join(f"contains(text, {_lit(v)})::int" for v in T.FACTS.values())})::bigint from m where text is not null""")
def rag_counters(spark: SparkSession, d: str) -> DataFrame:
    m = _base(spark, d)
    rows = [("rag_segments", D.segments(m).count()), ("rag_facts", D.knowledge_facts(m).count()), ("conversations", m.select("conversation_id").distinct().count())]
    return spark.createDataFrame(rows, "metric string, n bigint")


@query(f"""with {BASE}, f as (select conversation_id, ts, ordinal, message_id, 0 as pos, 'order_id' as reference_type, '#' || regexp_extract(text, '#([0-9]+)', 1) as value from m where regexp_matches(text, '#[0-9]+')
 {" ".join(f"union all select conversation_id, ts, ordinal, message_id, {i + 1}, {_lit(k)}, {_lit(v)} from m where contains(text, {_lit(v)})" for i, (k, v) in enumerate(T.FACTS.items()))})
select conversation_id || '_fact_' || (row_number() over (partition by conversation_id {_ORDERED}, pos) - 1)::varchar as chunk_id, message_id, reference_type, value from f""")
def rag_facts(spark: SparkSession, d: str) -> DataFrame:
    return D.knowledge_facts(_base(spark, d)).select("chunk_id", "message_id", "reference_type", "value")


@query("""select conversation_id, unnest(detected_languages).message_id as message_id from language_annotations where false union all
select conversation_id, d.message_id from (select conversation_id, unnest(detected_languages) as d from language_annotations) where len(list_filter(d.languages, lambda x: x <> 'en - English')) > 0""")
def translation_candidates(spark: SparkSession, d: str) -> DataFrame:
    a = read_table(spark, d, "language_annotations").select("conversation_id", F.explode("detected_languages").alias("d")).select("conversation_id", "d.*")
    return a.where(F.exists("languages", lambda x: x != "en - English")).select("conversation_id", "message_id")


@query(f"with {BASE} select conversation_id, sha256(string_agg(coalesce(text, ''), '|' {_ORDERED})) as text_hash from m group by conversation_id")
def translation_hash(spark: SparkSession, d: str) -> DataFrame:
    return D.translation_hash(_base(spark, d))


_FOREIGN = f"f as (select m.* from m join {_MESSAGES_OF} a using (message_id) where len(list_filter(a.languages, lambda x: x <> 'en - English')) > 0)"
#: A ledger that has the present hash of every second conversation and another one of the rest that it knows.
_LEDGER = "h as (select conversation_id, sha256(string_agg(coalesce(text, ''), '|' order by ts, ordinal, message_id)) as text_hash from f group by 1), g as (select conversation_id, case when ascii(right(conversation_id, 1)) % 2 = 0 then text_hash else 'old' end as text_hash from h where ascii(right(conversation_id, 1)) % 3 > 0)"


def _foreign(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(messages, their languages, ledger)."""
    m = _base(spark, d)
    languages = D.message_languages(m, read_table(spark, d, "language_annotations"))
    last = F.ascii(F.right("conversation_id", F.lit(1)))
    hashes = D.translation_hash(D.regional(m, languages))
    return m, languages, hashes.where(last % 3 > 0).withColumn("text_hash", F.when(last % 2 == 0, F.col("text_hash")).otherwise("old"))


@query(f"with {BASE}, {_FOREIGN}, {_LEDGER} select conversation_id, h.text_hash as text_hash from h left join g using (conversation_id) where h.text_hash is distinct from g.text_hash")
def translation_pending(spark: SparkSession, d: str) -> DataFrame:
    m, languages, ledger = _foreign(spark, d)
    return D.changed(D.translation_hash(D.regional(m, languages)), ledger)


class Shout:
    """Stands for a translating model: upper case, in brackets; answers nothing for texts that start with "H"."""

    def rewrite(self, texts: dict[str, str]) -> dict[str, str]:
        return {k: f"<{len(t)} {t[:3]}>" for k, t in texts.items() if not t.startswith("H")}


@query(f"""with {BASE}, {_FOREIGN}, {_LEDGER}, p as (select conversation_id from h left join g using (conversation_id) where h.text_hash is distinct from g.text_hash),
 n as (select message_id, '<' || length(coalesce(text, ''))::varchar || ' ' || left(coalesce(text, ''), 3) || '>' as new from f where conversation_id in (select conversation_id from p) and not starts_with(coalesce(text, ''), 'H'))
select m.message_id, md5(coalesce(new, text)) as digest from m left join n using (message_id)""")
def translation_applied(spark: SparkSession, d: str) -> DataFrame:
    done, _ = E.translate(*_foreign(spark, d), Shout)
    return done.select("message_id", F.md5("text").alias("digest"))


@query(f"""with {BASE}, {_FOREIGN}, {_LEDGER}, p as (select conversation_id from h left join g using (conversation_id) where h.text_hash is distinct from g.text_hash),
 t as (select conversation_id, ts, ordinal, message_id, case when starts_with(coalesce(text, ''), 'H') then text else '<' || length(coalesce(text, ''))::varchar || ' ' || left(coalesce(text, ''), 3) || '>' end as text from f where conversation_id in (select conversation_id from p))
select conversation_id, sha256(string_agg(coalesce(text, ''), '|' order by ts, ordinal, message_id)) as text_hash from t group by 1 union all select conversation_id, text_hash from g where conversation_id not in (select conversation_id from p)""")
def translation_ledger(spark: SparkSession, d: str) -> DataFrame:
    _, ledger = E.translate(*_foreign(spark, d), Shout)
    return ledger


@query(f"""with {BASE} select message_id, case when lower(trim(speaker)) in ('agent', 'support', 'bot') then 'assistant' else speaker end as speaker from m""")
def role_update(spark: SparkSession, d: str) -> DataFrame:
    m = _base(spark, d)
    roles = m.where(F.col("speaker").isin("agent", "support", "bot")).select("message_id", F.lit("assistant").alias("speaker"))
    return D.update_roles(m, roles).select("message_id", "speaker")


@query(f"""with v as (select doc_type = 'mail' as is_mail, text from documents),
 x as (select is_mail, count(*) as documents, sum(len({_words("coalesce(text, '')")}))::bigint as words, sum(length(coalesce(text, '')))::bigint as chars from v group by 1),
 u as (select is_mail, metric, value from x unpivot (value for metric in (documents, words, chars)))
select coalesce(a.metric, b.metric) as metric, coalesce(a.value, 0) as v1, coalesce(b.value, 0) as v2, coalesce(b.value, 0) - coalesce(a.value, 0) as delta
from (select * from u where is_mail) a full join (select * from u where not is_mail) b on a.metric = b.metric""")
def version_diff(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents")
    text = F.coalesce("text", F.lit(""))

    def metrics(x: DataFrame) -> DataFrame:
        one = x.agg(F.count("*").alias("documents"), F.sum(F.size(T.words(text))).alias("words"), F.sum(F.length(text)).cast("long").alias("chars"))
        return one.unpivot([], ["documents", "words", "chars"], "metric", "value")

    return D.metric_diff(metrics(docs.where("doc_type = 'mail'")), metrics(docs.where("doc_type <> 'mail'")))


@query(f"""with {BASE}, t as (select *, row_number() over (partition by conversation_id {_ORDERED}) as k from m)
select conversation_id, string_agg(message_id, ',' order by k) as first_messages from t where k <= 5 and conversation_id not in (select conversation_id from language_annotations) group by conversation_id""")
def details_pending(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    pending = D.without(_base(spark, d), read_table(spark, d, "language_annotations")).select("conversation_id", *H.ORDER)
    w = Window.partitionBy("conversation_id").orderBy(*H.ORDER)
    first = pending.withColumn("k", F.row_number().over(w)).where("k <= 5").groupBy("conversation_id").agg(F.array_sort(F.collect_list(F.struct("k", "message_id"))).alias("m"))
    return first.select("conversation_id", F.array_join(F.transform("m", lambda x: x["message_id"]), ",").alias("first_messages"))


# --- normalisation --------------------------------------------------------------------------------


@query("""select message_id, 'email_thread_' || md5(case when k = '' then 'no-subject' else k end) as thread_key from
 (select message_id, trim(regexp_replace(lower(coalesce(min(metadata['subject']), '')), '^(re|fwd|fw|reply|forward):\\s*', ''), e' \\t\\n\\r') as k from messages where source = 'gmail' group by message_id)""")
def thread_key(spark: SparkSession, d: str) -> DataFrame:
    m = read_table(spark, d, "messages").where("source = 'gmail'").groupBy("message_id").agg(F.min(F.col("metadata")["subject"]).alias("s"))
    return m.select("message_id", N.thread_key(F.col("s")).alias("thread_key"))


_FORMATS = "['%d/%m/{y} %H:%M:%S', '%d/%m/{y} %H:%M', '%d/%m/{y} %I:%M:%S %p', '%d/%m/{y} %I:%M %p', '%m/%d/{y} %H:%M:%S', '%m/%d/{y} %I:%M %p']"


@query(f"""with t as (select distinct message_id, timestamp, upper({_bare("array_to_string(list_filter([p[1], p[2]], lambda x: x is not null), ' ')")}) as x from (select message_id, timestamp, string_split(regexp_replace(timestamp, '[\\[\\]]', '', 'g'), ', ') as p from messages)),
 u as (select message_id, timestamp, case when regexp_matches(x, '^[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}} ') then try_strptime(x, {_FORMATS.format(y="%Y")}) when regexp_matches(x, '^[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{2}} ') then try_strptime(x, {_FORMATS.format(y="%y")}) end as ts from t)
select message_id, timestamp, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as parsed from u where ts is not null""")
def parse_timestamps(spark: SparkSession, d: str) -> DataFrame:
    m = read_table(spark, d, "messages").select("message_id", "timestamp").distinct()
    x = F.split(F.regexp_replace("timestamp", r"[\[\]]", ""), ", ")
    t = chat_logs.timestamp(F.get(x, F.lit(0)), F.get(x, F.lit(1)), F.lit(None).cast("timestamp"))
    return m.select("message_id", "timestamp", N.iso(t).alias("parsed")).where("parsed is not null")


@query()
def parse_chat_log(spark: SparkSession, d: str) -> DataFrame:
    """Round trip: every chat conversation written as an export, then parsed again."""
    m = _base(spark, d).where("source = 'whatsapp' and text is not null")
    head = F.concat(F.lit("["), F.date_format("ts", "dd/MM/yyyy, HH:mm:ss"), F.lit("] "), F.coalesce("speaker", F.lit("none")), F.lit(": "))
    line = F.concat(head, "text")
    logs = m.groupBy(F.col("conversation_id").alias("file")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ts", "ordinal", "message_id", line.alias("l")))), lambda x: x["l"]), "\n").alias("content"))
    return chat_logs.parse(logs)


_HEAD = "'^(.*?)<([^<>]+)>\\s*$'"


@query(f"""with r as (select distinct conversation_id, metadata['raw_speaker_name'] as raw from messages where conversation_id is not null and metadata['raw_speaker_name'] is not null),
 p as (select conversation_id, unnest(case when regexp_matches(raw, '<[^<>]+>\\s*$') then [regexp_replace({_bare(f"regexp_extract(raw, {_HEAD}, 1)")}, '^"|"$', '', 'g'), {_bare(f"regexp_extract(raw, {_HEAD}, 2)")}] else [{_bare("raw")}] end) as participant from r)
select distinct conversation_id, participant from p where participant <> ''""")
def participants(spark: SparkSession, d: str) -> DataFrame:
    m = read_table(spark, d, "messages").select("conversation_id", D.participants(F.col("metadata")["raw_speaker_name"]).alias("p")).where("conversation_id is not null")
    return m.select("conversation_id", F.explode("p").alias("participant")).distinct()
