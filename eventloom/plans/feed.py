"""The activity feed: one readable sentence per activity."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, payload
from ..functions.columns import or_blank, phrase
from . import event_fields as ef
from .events import _named, _push_extras, on_days


# A sentence is a pair of SQL expressions over a typed table: activity id and text.
Sentence = tuple[str, str]


def _suffixed(present: str, *parts: str) -> str:
    """event_id:part:part where `present` is known, else event_id alone."""
    joined = ", ':', ".join(["event_id", *parts])
    return f"CASE WHEN {present} IS NOT NULL THEN concat({joined}) ELSE event_id END"


def _by_value(column: str, sentences: dict[str, str], other: str) -> str:
    cases = " ".join(f"WHEN '{value}' THEN {text}" for value, text in sentences.items())
    return f"CASE {column} {cases} ELSE {other} END"


def _action(column: str) -> str:
    return f"coalesce({column}, '{fixed.FEED_DEFAULT_ACTION}')"


def _number(column: str) -> str:
    return f"cast({column} AS string)"


def _push() -> Sentence:
    text = phrase(
        fixed.FEED_PUSH,
        user="user_login",
        repo=or_blank("repo_name"),
        ref=or_blank("ref_name"),
        sha=or_blank("commit_sha", 7),
        message=or_blank("commit_message", 120),
    )
    return _suffixed("commit_sha", "commit_sha"), text


def _issues() -> Sentence:
    parts = {"user": "user_login", "number": _number("issue_number")}
    text = _by_value(
        "issue_action",
        {
            "opened": phrase(fixed.FEED_ISSUE_OPENED, **parts, title=or_blank("issue_title", 120)),
            "closed": phrase(fixed.FEED_ISSUE_CLOSED, **parts),
            "reopened": phrase(fixed.FEED_ISSUE_REOPENED, **parts),
        },
        phrase(fixed.FEED_ISSUE_OTHER, **parts, action=_action("issue_action")),
    )
    return "event_id", text


def _issue_comment() -> Sentence:
    text = phrase(
        fixed.FEED_ISSUE_COMMENT,
        user="user_login",
        number=_number("issue_number"),
        body=or_blank("comment_body", 120),
    )
    return _suffixed("comment_id", _number("comment_id")), text


def _pull_request() -> Sentence:
    parts = {"user": "user_login", "number": _number("pr_number")}
    merged, closed = (phrase(text, **parts) for text in (fixed.FEED_PR_MERGED, fixed.FEED_PR_CLOSED))
    text = _by_value(
        "pr_action",
        {
            "opened": phrase(fixed.FEED_PR_OPENED, **parts, title=or_blank("pr_title", 120)),
            "closed": f"CASE WHEN is_merged THEN {merged} ELSE {closed} END",
            "synchronize": phrase(fixed.FEED_PR_SYNCHRONIZED, **parts),
        },
        phrase(fixed.FEED_PR_OTHER, **parts, action=_action("pr_action")),
    )
    return "event_id", text


def _review() -> Sentence:
    state, number = or_blank("review_state"), _number("pr_number")
    text = phrase(fixed.FEED_PR_REVIEW, user="user_login", number=number, state=state)
    return _suffixed("review_submitted_at_utc", number, state), text


def _review_comment() -> Sentence:
    text = phrase(
        fixed.FEED_PR_REVIEW_COMMENT,
        user="user_login",
        number=_number("pr_number"),
        path=or_blank("file_path", 80),
    )
    return _suffixed("review_comment_id", _number("review_comment_id")), text


def _watch() -> Sentence:
    return "event_id", phrase(fixed.FEED_WATCH, user="user_login", repo=or_blank("repo_name"))


def _fork() -> Sentence:
    text = phrase(
        fixed.FEED_FORK,
        user="user_login",
        repo=or_blank("repo_name"),
        forkee=or_blank("forkee_full_name"),
    )
    return "event_id", text


def _member() -> Sentence:
    parts = {"user": "user_login", "member": or_blank("member_login")}
    text = _by_value(
        "member_action",
        {
            "added": phrase(fixed.FEED_MEMBER_ADDED, **parts),
            "removed": phrase(fixed.FEED_MEMBER_REMOVED, **parts),
        },
        phrase(fixed.FEED_MEMBER_OTHER, **parts),
    )
    return "event_id", text


def _create() -> Sentence:
    parts = {"user": "user_login", "ref": or_blank("created_ref_name")}
    text = _by_value(
        "created_ref_type",
        {
            "repository": phrase(fixed.FEED_CREATE_REPOSITORY, user="user_login"),
            "branch": phrase(fixed.FEED_CREATE_BRANCH, **parts),
            "tag": phrase(fixed.FEED_CREATE_TAG, **parts),
        },
        phrase(fixed.FEED_CREATE_OTHER, **parts),
    )
    return "event_id", text


def _delete() -> Sentence:
    parts = {"user": "user_login", "ref": or_blank("deleted_ref_name")}
    text = _by_value(
        "deleted_ref_type",
        {
            "branch": phrase(fixed.FEED_DELETE_BRANCH, **parts),
            "tag": phrase(fixed.FEED_DELETE_TAG, **parts),
        },
        phrase(fixed.FEED_DELETE_OTHER, **parts, kind=or_blank("deleted_ref_type")),
    )
    return "event_id", text


def _gollum() -> Sentence:
    text = phrase(
        fixed.FEED_GOLLUM,
        user="user_login",
        title=or_blank("page_title"),
        action=_action("page_action"),
    )
    return _suffixed("page_sha", "page_sha"), text


SENTENCES: dict[str, tuple[ef.EventShape, Sentence]] = {
    shape.event_type: (shape, sentence())
    for shape, sentence in (
        (ef.PUSH, _push),
        (ef.ISSUES, _issues),
        (ef.ISSUE_COMMENT, _issue_comment),
        (ef.PULL_REQUEST, _pull_request),
        (ef.REVIEW, _review),
        (ef.REVIEW_COMMENT, _review_comment),
        (ef.WATCH, _watch),
        (ef.FORK, _fork),
        (ef.MEMBER, _member),
        (ef.CREATE, _create),
        (ef.DELETE, _delete),
        (ef.GOLLUM, _gollum),
    )
}


def _feed_rows(rows: DataFrame, event_type: str, key: str, text: str) -> DataFrame:
    return rows.selectExpr(
        f"{key} AS activity_id",
        f"{event_type} AS source_event_type",
        "organization",
        "repo_name",
        "user_login AS actor_login",
        f"{text} AS activity_text",
        "ts_kst",
        "base_date",
    )


def feed_from_tables(
    tables: Mapping[str, DataFrame], days: Iterable[date] | None = None
) -> DataFrame:
    """The feed over stored typed tables: one branch per table, all pruned by day."""
    branches = [
        _feed_rows(on_days(tables[shape.table], days, "base_date"), f"'{event_type}'", key, text)
        for event_type, (shape, (key, text)) in SENTENCES.items()
    ]
    return reduce(DataFrame.unionByName, branches)


# Payload fields the sentences read. Names are the typed tables' column names,
# and a name stands for the same path in every type that has it.
_FEED_FIELD_NAMES = frozenset(
    """
    ref_full issue_action issue_number issue_title comment_id comment_body pr_action pr_number
    pr_title is_merged review_state review_submitted_at_utc review_comment_id file_path
    forkee_full_name member_login member_action created_ref_type created_ref_name
    deleted_ref_type deleted_ref_name
    """.split()
)
_FEED_ITEM_NAMES = frozenset("commit_sha commit_message page_title page_action page_sha".split())


def _feed_fields(items: bool) -> list[payload.Field]:
    wanted = _FEED_ITEM_NAMES if items else _FEED_FIELD_NAMES
    found: dict[str, payload.Field] = {}
    for shape, _ in SENTENCES.values():
        for field in shape.item_fields if items else shape.fields:
            if field[0] in wanted:
                found.setdefault(field[0], field)
    return list(found.values())


def dw_activity_feed(events: DataFrame, days: Iterable[date] | None = None) -> DataFrame:
    """The feed straight from the event table: one scan, one parse per payload.

    Rows equal `feed_from_tables` over the typed tables, without reading the
    event table twelve times.
    """
    fields, item_fields = _feed_fields(False), _feed_fields(True)
    own = on_days(events, days).where(F.col("type").isin(*SENTENCES))
    rows = _named(own, "user_login", "type", "payload")
    rows = payload.with_parsed(rows, "payload", "_p", fields, ("commits", "pages"))
    items = F.expr(
        f"CASE type WHEN '{ef.PUSH.event_type}' THEN _p.commits "
        f"WHEN '{ef.GOLLUM.event_type}' THEN _p.pages ELSE array(cast(NULL AS string)) END"
    )
    rows = payload.with_fields(rows, "_p", fields).withColumn("_item", F.explode(items))
    rows = payload.with_parsed(rows.drop("_p", "payload"), "_item", "_i", item_fields)
    rows = payload.with_fields(rows, "_i", item_fields)
    rows = rows.withColumns({"ref_name": _push_extras({})["ref_name"]})

    keys, texts = (
        " ".join(f"WHEN '{kind}' THEN {sentence[n]}" for kind, (_, sentence) in SENTENCES.items())
        for n in (0, 1)
    )
    return _feed_rows(rows, "type", f"CASE type {keys} END", f"CASE type {texts} END")
