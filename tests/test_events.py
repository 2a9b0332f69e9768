import json
import re

import pytest
from pyspark.sql import functions as F

from eventloom.plans import build, events, feed
from eventloom.plans.event_fields import EVENT_SHAPES
from eventloom.sources import supplied


def frame(spark, kind, *payloads, repo='{"name":"a/b"}', org='{"login":"a"}', organization="part"):
    rows = [
        (str(n), kind, '{"login":"me"}', repo, org, p if isinstance(p, str) or p is None else json.dumps(p), organization)
        for n, p in enumerate(payloads)
    ]
    df = spark.createDataFrame(
        rows,
        "id string, type string, actor string, repo string, org string, payload string, organization string",
    )
    return df.selectExpr(
        "*", "timestamp_ntz'2024-01-15 12:00:00' as ts_kst", "date'2024-01-15' as dt_kst"
    )


def typed(spark, name, *payloads, **more):
    shape = EVENT_SHAPES[name]
    return events.typed_events(frame(spark, shape.event_type, *payloads, **more), shape).collect()


def test_organization_falls_back_to_owner_then_partition(spark):
    def organization(repo, org=None):
        df = frame(spark, "WatchEvent", {}, repo=repo, org=org)
        return events.stg_gh_events(df).first().organization

    assert organization('{"name":"x/y"}', '{"login":"z"}') == "z"
    assert organization('{"name":"x/y"}') == "x"
    assert organization('{"name":"y"}') == "part"
    assert organization(None) == "part"


def test_pushes_give_one_row_per_commit(spark):
    commits = [{"sha": f"s{n}", "message": "[1]", "author": {"name": "n"}, "distinct": True} for n in range(3)]
    rows = typed(
        spark, "dl_push_events", {"commits": []}, {}, {"commits": None}, None, "oops",
        {"commits": commits, "ref": "refs/tags/v1", "size": "3", "push_id": 12.5},
    )
    assert [(row.event_id, row.commit_sha) for row in rows] == [("5", f"s{n}") for n in range(3)]
    row = rows[0]
    assert (row.ref_name, row.is_tag_ref, row.is_branch_ref, row.size, row.push_id) == ("v1", True, False, 3, None)
    # a message that is valid JSON stays text
    assert row.commit_message == "[1]" and row.commit_distinct is True


def test_numbers(spark):
    rows = typed(spark, "dl_issues_events", *[{"issue": {"number": n}} for n in ("12", 12, 12.5, "x", None)])
    assert [row.issue_number for row in rows] == [12, 12, None, None, None]


def test_object_where_text_belongs(spark):
    about = [{}, {"a": 1}, [1], "{}", "[x] y", '{"a":1}', "plain", None]
    rows = typed(spark, "dl_fork_events", *[{"forkee": {"description": text, "id": "7"}} for text in about])
    assert [row.forkee_description for row in rows] == [None, None, None, "{}", "[x] y", '{"a":1}', "plain", None]
    assert {row.forkee_id for row in rows} == {7}


def test_flags_are_never_null(spark):
    rows = typed(spark, "dl_create_events", {"ref_type": "tag"}, {}, None)
    assert [(r.is_repo_creation, r.is_branch_creation, r.is_tag_creation) for r in rows] == [
        (False, False, True), (False, False, False), (False, False, False)
    ]


def test_review_times_are_the_same_text(spark):
    row = typed(spark, "dl_pull_request_review_events", {"review": {"submitted_at": "2024-01-01T00:00:00Z"}})[0]
    assert row.review_submitted_at_kst == row.review_submitted_at_utc == "2024-01-01T00:00:00Z"


def test_feed_text(spark):
    def texts(kind, *payloads):
        rows = feed.dw_activity_feed(frame(spark, kind, *payloads)).orderBy("activity_id").collect()
        return [(row.activity_id, row.activity_text) for row in rows]

    assert texts("IssuesEvent", {"action": "opened", "issue": {}}) == [("0", None)]
    assert texts("IssuesEvent", {"issue": {"number": 4}}) == [("0", "me이 이슈 #4 업데이트")]
    assert texts("PullRequestEvent", {"action": "closed", "pull_request": {"number": 5, "merged": True}}) == [
        ("0", "me이 PR #5 병합")
    ]
    long = "가" * 200
    assert texts("IssueCommentEvent", {"issue": {"number": 4}, "comment": {"id": 8, "body": long}}) == [
        ("0:8", "me이 이슈 #4에 댓글: " + "가" * 120)
    ]
    assert texts("PullRequestReviewEvent", {"review": {"submitted_at": "x"}}) == [(None, None)]
    assert texts("PushEvent", {"commits": [{"sha": "0123456789", "message": "m"}], "ref": "refs/heads/x"}) == [
        ("0:0123456789", "me이 a/b:x에 0123456 푸시: m")
    ]
    assert texts("GollumEvent", {"pages": [{"title": "T"}]}) == [("0", "me이 위키 T 업데이트")]
    assert texts("ReleaseEvent", {}) == []


def test_parsed_payload_is_not_parsed_again_for_a_filter(spark):
    shape = build.EVENT_SHAPES["dl_issues_events"]
    rows = events.typed_events(frame(spark, shape.event_type, {"issue": {"number": 1}}), shape)
    plan = rows.where(F.col("issue_number") > 0)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_union_feed_equals_single_pass(spark):
    from eventloom.sources import supplied

    source = supplied.filtered_events(spark, "/root/testdata/sf0.001")
    one = feed.dw_activity_feed(source)
    many = feed.feed_from_tables(events.typed_tables(source))
    assert sorted(map(repr, one.collect())) == sorted(map(repr, many.collect()))


def test_typed_schemas(spark):
    empty = frame(spark, "x")
    for name, shape in EVENT_SHAPES.items():
        built = events.typed_events(empty, shape).schema
        declared = events.typed_schema(shape)
        assert [(f.name, f.dataType) for f in built] == [(f.name, f.dataType) for f in declared], name


@pytest.mark.parametrize(
    ("derive", "long", "text"),
    [(supplied.filtered_events, "payload", supplied.PAYLOAD), (supplied.archive_lines, "value", supplied.LINE)],
)
def test_long_texts_are_not_fused_into_one_method(spark, tmp_path, derive, long, text):
    """A fused method of that length is interpreted; the texts, also of NULLs, are those of the expression."""
    rows = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    odd = rows.limit(1).selectExpr("cast(null as bigint) as event_id", *rows.columns[1:])
    rows.unionByName(odd).write.parquet(str(tmp_path / "events.parquet"))
    derived = derive(spark, str(tmp_path))
    plan = derived._jdf.queryExecution().executedPlan().toString()
    assert "Project" in plan and not re.search(r"\*\(\d+\) Project", plan)
    whole = spark.read.parquet(str(tmp_path / "events.parquet"))
    plain = whole.selectExpr(f"{text.replace('varchar(40)', 'string')} as `{long}`")
    assert derived.count() == whole.count()
    assert derived.select(long).exceptAll(plain).count() == plain.exceptAll(derived.select(long)).count() == 0
