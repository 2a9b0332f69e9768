"""The supplied tables read as archive events, facts and relation pages.

The supplied data holds no code-hosting events, so they are derived from its
`events` and `orders` tables row by row, with expressions that mean the same in
Spark SQL and in ANSI SQL engines. Every row of the table becomes one row.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def _text(expression: str) -> str:
    return f"cast({expression} as varchar(40))"


def _pick(selector: str, *values: str | None) -> str:
    """CASE over 0, 1, 2, ... giving the texts in turn."""
    cases = " ".join(
        f"when {n} then {'null' if value is None else repr(value)}" for n, value in enumerate(values)
    )
    return f"(case {selector} {cases} end)"


def _quoted_or_null(expression: str) -> str:
    """JSON text of a string that may be NULL."""
    return f"""coalesce('"' || {expression} || '"', 'null')"""


def _fill(template: str, values: dict[str, str]) -> str:
    """SQL text that builds the template, with each <name> replaced by its value.

    Line breaks and indents of the template are dropped.
    """
    template = "".join(line.strip() for line in template.splitlines())
    pieces = []
    for literal, name in re.findall(r"([^<>]*)(?:<(\w+)>)?", template):
        if literal:
            pieces.append(f"'{literal}'")
        if name:
            pieces.append(values[name])
    return " || ".join(pieces)


# --- events ------------------------------------------------------------------

_TYPES = (
    "PushEvent", "IssuesEvent", "IssueCommentEvent", "PullRequestEvent",
    "PullRequestReviewEvent", "PullRequestReviewCommentEvent", "WatchEvent", "ForkEvent",
    "MemberEvent", "CreateEvent", "DeleteEvent", "GollumEvent", "ReleaseEvent",
)
_TURN = "cast(floor(event_id / 13) as bigint)"

EVENT_TYPE = _pick("event_id % 13", *_TYPES)
ORG_LOGIN = _pick("user_id % 4", "CausalInferenceLab", "Pseudo-Lab", "apache", "HTTPServer")
ORG_PARTITION = _pick("user_id % 4", "causal_inference_lab", "pseudo__lab", "apache", "http_server")
REPO_SHORT = _pick(
    "cast(floor(event_id / 3) as bigint) % 5", "superset", "study", "docs", "Wiki-Notes", "core"
)
USER = f"('u' || {_text('user_id')})"
MAYBE_USER = f"(case when event_id % 101 = 0 then null else {USER} end)"
CREATED_AT = "replace(substr(cast(ts as varchar(40)), 1, 19), ' ', 'T') || 'Z'"

_ACTION_5 = {
    "issue": ("opened", "closed", "reopened", "labeled", None),
    "pull": ("opened", "closed", "synchronize", "labeled", None),
}
_VALUES = {
    "event": _text("event_id"),
    "event_2": _text("event_id * 2"),
    "event_3": _text("event_id * 3"),
    "event_5": _text("event_id * 5"),
    "repo_id": _text("event_id % 5"),
    "org_id": _text("user_id % 4"),
    "user_id": _text("user_id"),
    "user": USER,
    "kind": "event_type",
    "org": ORG_LOGIN,
    "repo": f"(case when event_id % 11 = 0 then '' else {ORG_LOGIN} || '/' end) || {REPO_SHORT}",
    "other": f"'u' || {_text('(user_id * 7 + event_id) % 50')}",
    "other_id": _text("(user_id * 7 + event_id) % 50"),
    "sha": f"'c' || {_text('event_id')} || 'abcdef0123456789'",
    # a ticket in brackets is text, though it looks like a list
    "title": f"(case when {_TURN} % 7 = 0 then '[SPARK-1] ' when {_TURN} % 7 = 3 then '[1' else '' end) || event_type || ' ' || chr(92) || '\"' || {_text('value')} || chr(92) || '\" ' || repeat('가나다 ', 40)",
    "deep": "repeat('/deep', 20)",
    "size": _text("event_id % 3"),
    "small": _text("event_id % 9"),
    "large": _text("event_id % 1000"),
    "even": _pick("event_id % 2", "true", "false"),
    "third": _pick("event_id % 3", "true", "false", "null"),
    "state": _pick("event_id % 2", "open", "closed"),
    "ref": _pick(f"{_TURN} % 3", "refs/heads/main", "refs/tags/v1", "refs/heads/feature/x"),
    "number": f"(case when {_TURN} % 29 = 0 then 'null' else {_text(f'(user_id * 3 + {_TURN}) % 23')} end)",
    "comment_id": f"(case when {_TURN} % 17 = 0 then 'null' else {_text('event_id * 10')} end)",
    "issue_action": _quoted_or_null(_pick(f"{_TURN} % 5", *_ACTION_5["issue"])),
    "pull_action": _quoted_or_null(_pick(f"{_TURN} % 5", *_ACTION_5["pull"])),
    "review_state": _quoted_or_null(
        _pick(f"{_TURN} % 4", "approved", "commented", "changes_requested", None)
    ),
    "submitted": _quoted_or_null(f"(case when {_TURN} % 8 = 0 then null else {CREATED_AT} end)"),
    "member_action": _quoted_or_null(_pick(f"{_TURN} % 4", "added", "removed", "edited", None)),
    "create_ref": _quoted_or_null(_pick(f"{_TURN} % 4", None, "dev", "v1.0", "odd")),
    "create_type": _pick(f"{_TURN} % 4", "repository", "branch", "tag", "other"),
    "delete_ref": _pick(f"{_TURN} % 3", "dev", "v1.0", "odd"),
    "delete_type": _quoted_or_null(_pick(f"{_TURN} % 3", "branch", "tag", None)),
    "page_action": _quoted_or_null(_pick(f"{_TURN} % 4", "created", "edited", "deleted", None)),
    "page_sha": f"(case when {_TURN} % 19 = 0 then 'null' else '\"c' || {_text('event_id')} || '\"' end)",
    # a nested value where text belongs, and text that only looks like one
    "pull_body": f"(case when {_TURN} % 6 = 0 then '{{\"nested\":1}}' else '\"{{not json\"' end)",
    "fork_about": f"(case when {_TURN} % 3 = 0 then '{{}}' when {_TURN} % 3 = 1 then '\"{{}}\"' else '\"about\"' end)",
}

ACTOR_JSON = (
    "case when event_id % 101 = 0 then '{}' else "
    + _fill('{"id":<user_id>,"login":"<user>"}', _VALUES)
    + " end"
)
REPO_JSON = (
    "case when event_id % 97 = 0 then '{}' else "
    + _fill('{"id":<repo_id>,"name":"<repo>"}', _VALUES)
    + " end"
)
ORG_JSON = (
    "case when event_id % 7 = 0 then null else "
    + _fill('{"id":<org_id>,"login":"<org>"}', _VALUES)
    + " end"
)

_PULL = """
    "number":<number>,"title":"<title>","html_url":"https://example.org/pull/<event>",
    "state":"<state>","user":{"login":"<other>","id":<other_id>}
"""
_ISSUE = """
    "issue":{"number":<number>,"title":"<title>","body":"[body] <kind>","state":"<state>",
    "html_url":"https://example.org/issues/<event>","user":{"login":"<other>","id":<other_id>}}
"""
_COMMENT = """
    "id":<comment_id>,"html_url":"https://example.org/comment/<event>","body":"<title>",
    "user":{"login":"<user>","id":<user_id>}
"""
_COMMIT = """
    {"sha":"<sha>","author":{"name":"<user>","email":"<user>@example.org"},"message":"[1] <title>",
    "distinct":<even>,"url":"https://example.org/commit/<event>"}
"""
_PAGE = """
    {"page_name":"Page-<small>","title":"Page <small>","summary":null,"action":<page_action>,
    "sha":<page_sha>,"html_url":"https://example.org/wiki/<small>"}
"""
_VALUES["commits"] = (
    f"(case {_TURN} % 4 when 0 then '' when 1 then {_fill(_COMMIT, _VALUES)} "
    f"else {_fill(_COMMIT + ',' + _COMMIT.replace('<sha>', '<sha>2').replace('[1]', '[2]'), _VALUES)} end)"
)
_VALUES["pages"] = (
    f"(case {_TURN} % 5 when 0 then '[]' when 1 then 'null' when 2 then {_fill('[' + _PAGE + ']', _VALUES)} "
    f"else {_fill('[' + _PAGE + ',' + _PAGE.replace('Page-', 'Other-') + ']', _VALUES)} end)"
)

_PAYLOADS = {
    "PushEvent": """
        {"repository_id":<repo_id>,"push_id":<event>,"size":"<size>","distinct_size":1.5,
        "ref":"<ref>","head":"<sha>","before":"<sha>b","commits":[<commits>]}
    """,
    # repeated keys: such a payload is no valid document to a strict parser
    "IssuesEvent": '{"action":<issue_action>,"twice":1,"twice":1,' + _ISSUE + "}",
    "IssueCommentEvent": '{"action":"created",' + _ISSUE + ',"comment":{' + _COMMENT + "}}",
    "PullRequestEvent": '{"action":<pull_action>,"twice":1,"twice":1,"number":<number>,"pull_request":{' + _PULL + """,
        "draft":<even>,"body":<pull_body>,"head":{"ref":"feature/x","sha":"<sha>"},
        "base":{"ref":"main","sha":"<sha>b"},"commits":<small>,"additions":<large>,
        "deletions":<small>,"changed_files":<size>,"comments":<size>,"review_comments":<small>,
        "merged":<third>,"merge_commit_sha":"<sha>"}}
    """,
    "PullRequestReviewEvent": """
        {"action":"submitted","review":{"user":{"login":"<user>","id":<user_id>},
        "state":<review_state>,"body":null,"html_url":"https://example.org/review/<event>",
        "commit_id":"<sha>","submitted_at":<submitted>},"pull_request":{""" + _PULL + "}}",
    "PullRequestReviewCommentEvent": '{"action":"created","comment":{' + _COMMENT + """,
        "diff_hunk":"@@ -1 +1 @@","path":"src/<kind><deep>","commit_id":"<sha>",
        "pull_request_review_id":<event_3>},"pull_request":{""" + _PULL + "}}",
    "WatchEvent": '{"action":"started"}',
    "ForkEvent": """
        {"forkee":{"id":<event_5>,"full_name":"<user>/fork","html_url":"https://example.org/fork/<event>",
        "owner":{"login":"<user>","id":<user_id>},"description":<fork_about>,"private":false,
        "default_branch":"main"}}
    """,
    "MemberEvent": """
        {"member":{"login":"<other>","id":<other_id>,"html_url":"https://example.org/<other>"},
        "action":<member_action>}
    """,
    "CreateEvent": """
        {"ref":<create_ref>,"ref_type":"<create_type>","master_branch":"main",
        "description":"About <kind>","pusher_type":"user"}
    """,
    "DeleteEvent": '{"ref":"<delete_ref>","ref_type":<delete_type>,"pusher_type":"user"}',
    "GollumEvent": '{"pages":<pages>}',
    "ReleaseEvent": "{}",
}
PAYLOAD = (
    "case event_id % 13 "
    + " ".join(
        f"when {n} then {_fill(_PAYLOADS[name], _VALUES)}" for n, name in enumerate(_TYPES)
    )
    + " end"
)

# The event table: NULL organizations and names without an owner are kept, so
# the fallbacks of the staging layer are exercised.
EVENT_COLUMNS = {
    "id": _text("event_id"),
    "type": EVENT_TYPE,
    "actor": ACTOR_JSON,
    "repo": REPO_JSON,
    "org": ORG_JSON,
    "payload": PAYLOAD,
    "public": "true",
    "created_at": "ts",
    "ts_utc": "ts",
    "dt_utc": "cast(ts as date)",
    "ts_kst": "ts + interval '9' hour",
    "dt_kst": "cast(ts + interval '9' hour as date)",
    "organization": ORG_PARTITION,
}

# Archive lines as they are before ingest, with blank, broken and undated ones.
_LINE_VALUES = _VALUES | {
    "type": f"(case when event_id % 113 = 0 then 'None' else {EVENT_TYPE} end)",
    "payload": f"({PAYLOAD})",
    "actor": f"({ACTOR_JSON})",
    "repo_json": f"({REPO_JSON})",
    "org_json": f"coalesce(({ORG_JSON}), 'null')",
    "at": f"(case when event_id % 109 = 0 then 'x' else {CREATED_AT} end)",
}
LINE = (
    "case when event_id % 103 = 0 then '' when event_id % 107 = 0 then '{\"id\":\"1\",\"org\":{' else "
    + _fill(
        """
        {"id":"<event>","type":"<type>","actor":<actor>,"repo":<repo_json>,
        "payload":<payload>,"public":true,"created_at":"<at>","org":<org_json>}
        """,
        _LINE_VALUES,
    )
    + " end"
)

# --- orders ------------------------------------------------------------------

# A daily fact over 150 days: few users per repo, many return days.
FACT_COLUMNS = {
    "base_date": "cast(date '2024-01-01' + cast((o_orderkey * 31 + o_custkey * 17) % 150 as int) as date)",
    "organization": "case when o_orderkey % 211 = 0 then null else "
    + _pick("o_orderkey % 3", "CausalInferenceLab", "Pseudo-Lab", "apache")
    + " end",
    "repo_name": "case when o_orderkey % 199 = 0 then null else "
    + _pick("cast(floor(o_orderkey / 3) as bigint) % 4", "superset", "study", "docs", "core")
    + " end",
    "event_type": _pick("o_orderkey % 13", *_TYPES),
    "user_login": f"case when o_orderkey % 97 = 0 then null else 'u' || {_text('o_custkey')} end",
}

# Landed pages of follower listings: one page of up to two entries per order.
_RELATED = _fill(
    '{"login":"Gh<n>","id":<n>,"type":"User","html_url":"https://example.org/Gh<n>","site_admin":false}',
    {"n": _text("o_orderkey % 977")},
)
PAGE_COLUMNS = {
    "username": f"'CamelUser-' || {_text('o_custkey')}",
    "relation_type": _pick("o_orderkey % 2", "follower", "following"),
    "page": "case when o_orderkey % 41 = 0 then '[]' when o_orderkey % 43 = 0 then '{\"message\":\"Not Found\"}' "
    f"when o_orderkey % 3 = 0 then '[' || {_RELATED} || ',' || {_RELATED} || ']' else '[' || {_RELATED} || ']' end",
    "collected_at": "cast(cast(date '2024-01-01' + cast(o_orderkey % 40 as int) as date) as varchar(40)) "
    f"|| 'T' || lpad({_text('o_custkey % 24')}, 2, '0') || ':59:59Z'",
}


# --- reading -----------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _select(df: DataFrame, columns: dict[str, str], long: str | None = None) -> DataFrame:
    """The columns; `long` names one whose expression is too long for one compiled method.

    Fused with the scan it would be one method of more than 8000 bytes, which the JVM never
    compiles but interprets: about three times the CPU time. A condition with a lambda, always true,
    keeps Spark from fusing, so the expression is compiled in pieces.
    """
    texts = {name: text.replace("varchar(40)", "string") for name, text in columns.items()}
    if long is not None:
        texts[long] = f"case when exists(array(event_id), n -> true) then {texts[long]} end"
    return df.selectExpr(*[f"{text} as `{name}`" for name, text in texts.items()])


def filtered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(_table(spark, sf_dir, "events"), EVENT_COLUMNS, long="payload")


def archive_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines in a `value` column, with the UTC day and hour of each."""
    columns = {"value": LINE, "utc_day": "cast(ts as date)", "hour": "cast(extract(hour from ts) as int)"}
    return _select(_table(spark, sf_dir, "events"), columns, long="value")


def order_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _select(_table(spark, sf_dir, "orders"), FACT_COLUMNS)
    return rows.groupBy(*FACT_COLUMNS).count().withColumnRenamed("count", "event_count")


def relation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(_table(spark, sf_dir, "orders"), PAGE_COLUMNS)
