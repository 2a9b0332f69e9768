from datetime import date

import pytest
from pyspark.sql import functions as F

from eventloom import schemas
from eventloom.plans import digest
from eventloom.sources import relations
from eventloom.sources.tables import read_report_array, report_table_name

FENCE = "`" * 3


def parsed(spark, *texts):
    df = spark.createDataFrame([(n, text) for n, text in enumerate(texts)], "n int, answer string")
    rows = digest.parse_reports(df, schemas.ACTOR_WEEK_REPORT).orderBy("n").collect()
    return [row.report and row.report.actor_login for row in rows]


def test_report_text(spark):
    body = '{"actor_login": "x"}'
    assert parsed(spark, body, f"{FENCE}\n{body}\n{FENCE}", f"{FENCE}json\n{body}\n{FENCE}", f"Hi {body} bye") == ["x"] * 4
    assert parsed(spark, "nothing", "", None, "{broken", "} {", '{"a": }') == [None] * 6
    # the first part that is a bare object wins, also over other braces; a bad one is final
    other = '{"actor_login": "y"}'
    assert parsed(spark, f"see {{a: {FENCE}{body}{FENCE} {FENCE}{other}{FENCE}", f"{{a}} {FENCE}{body}{FENCE}") == ["x", None]


def test_week_of():
    assert digest.week_of("2024-01-14") == (date(2024, 1, 8), date(2024, 1, 14))
    assert digest.week_of(date(2024, 1, 15))[0] == date(2024, 1, 15)


def extract(spark):
    rows = [
        (date(2024, 1, 8), "org", "org/a", "me", "PushEvent", "t1"),
        (date(2024, 1, 14), "org", "org/a", "you", "WatchEvent", "t2"),
        (date(2024, 1, 15), "org", "org/a", "me", "PushEvent", "next week"),
        (date(2024, 1, 9), "apache", "apache/b", "me", "PushEvent", "left out"),
        (date(2024, 1, 9), None, "b", "me", "PushEvent", "left out"),
        (date(2024, 1, 9), "org", None, None, "CreateEvent", "t3"),
    ]
    feed = spark.createDataFrame(
        rows, "base_date date, organization string, repo_name string, actor_login string, source_event_type string, activity_text string"
    )
    return digest.weekly_extract(feed, "2024-01-10")


def test_weekly_extract(spark):
    rows = extract(spark).collect()
    assert sorted(row.activity_text for row in rows) == ["t1", "t2", "t3"]
    assert {(row.week_start, row.week_end) for row in rows} == {(date(2024, 1, 8), date(2024, 1, 14))}


def test_groups_and_single(spark):
    week = extract(spark)
    assert digest.groups(week, digest.ACTOR_KEYS).count() == 2
    assert digest.groups(week, digest.REPO_KEYS).count() == 1
    assert digest.single_group(week, actor_login="me").count() == 1
    with pytest.raises(ValueError):
        digest.single_group(week, actor_login="nobody")


def test_prompt(spark):
    blocks = digest.digest_blocks(extract(spark), digest.ACTOR_KEYS)
    prompt = digest.digest_prompts(blocks, "{week_start}..{week_end}\n{tsv}").where("actor_login = 'me'").first().prompt
    assert prompt == (
        "2024-01-08..2024-01-14\nbase_date\torganization\trepo_name\tsource_event_type\tactivity_text\tactor_login\n"
        "2024-01-08\torg\torg/a\tPushEvent\tt1\tme"
    )


def test_digests(spark):
    repo = digest.weekly_repo_digest(extract(spark)).first()
    assert (repo.dev_events, repo.manage_events, repo.community_events) == (1, 0, 1)
    assert [(p.actor_login, p.notable_activity) for p in repo.contributors_top] == [("me", "PushEvent"), ("you", "WatchEvent")]
    actor = {row.actor_login: row for row in digest.weekly_actor_digest(extract(spark)).collect()}
    assert actor["me"].organization_set == ["org"]
    assert [(t.repo_name, t.events) for t in actor["me"].top_repos] == [("org/a", ["PushEvent"])]


def test_report_files_and_table_names(spark, tables, tmp_path):
    file = tmp_path / "reports.json"
    file.write_text('[{"actor_login": "x", "highlights": ["h"]},\n {"actor_login": "y"}]')
    rows = read_report_array(spark, str(file), schemas.ACTOR_WEEK_REPORT)
    assert sorted(row.actor_login for row in rows.collect()) == ["x", "y"]
    assert report_table_name(rows) == "dl_actor_week"
    assert report_table_name(rows.select("actor_login")) == "dl_results"
    assert report_table_name(spark.createDataFrame([], schemas.REPO_WEEK_REPORT)) == "dl_repo_week"
    answers = spark.createDataFrame([('{"actor_login": "x"}',), ("no",)], "answer string")
    for count in (1, 2):
        digest.store_reports(tables, digest.parse_reports(answers, schemas.ACTOR_WEEK_REPORT))
        assert tables.read("dl_actor_week").count() == count


def test_relations(spark, tables):
    pages = spark.createDataFrame(
        [
            (" OctoCat ", "follower", '[{"login":"a","id":1,"type":"User","html_url":"h","x":[1]},{"login":"b","id":"2"}]', "2024-01-15T16:00:00Z"),
            ("", "follower", '[{"login":"a"}]', "2024-01-15T16:00:00Z"),
            ("me", "following", '{"message":"Not Found"}', "2024-01-15T16:00:00Z"),
            ("me", "following", "[]", "2024-01-15T16:00:00Z"),
            ("me", "following", None, "2024-01-15T16:00:00Z"),
        ],
        schemas.RELATION_PAGE,
    )
    out = relations.user_relations(pages)
    assert out.schema == schemas.USER_RELATIONS
    rows = {row.related_login: row for row in out.collect()}
    assert set(rows) == {"a", "b"} and rows["b"].related_id == 2
    assert rows["a"].username == "octo_cat" and rows["a"].dt_kst == date(2024, 1, 16)
    assert rows["a"].raw == '{"login":"a","id":1,"type":"User","html_url":"h","x":[1]}'
    relations.write_user_relations(tables, out)
    assert tables.days("gh_user_relations", "dt_kst") == ["2024-01-16"]


def test_follower_targets(spark):
    users = spark.createDataFrame(
        [("org", "a"), ("org", " a "), ("org", " "), ("org", None), ("apache", "b"), (None, "c")],
        "organization string, user_login string",
    )
    assert [row.user_login for row in relations.follower_targets(users).collect()] == ["a"]
