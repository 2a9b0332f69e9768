"""Lists, weights and texts that results must agree on."""

from __future__ import annotations

# Organizations kept at ingest, and those left out of digests.
TARGET_ORGANIZATIONS = ("CausalInferenceLab", "Pseudo-Lab", "apache")
DIGEST_EXCLUDED_ORGANIZATION = "apache"

# Scope of the active-user mart.
ACTIVE_ORGANIZATIONS = ("CausalInferenceLab", "Pseudo-Lab")
ACTIVE_REPOSITORIES = ("superset",)

# Activity classes by event type.
LIGHT_TYPES = ("WatchEvent", "ForkEvent")
MEDIUM_TYPES = ("PushEvent", "CreateEvent", "DeleteEvent")
HEAVY_TYPES = (
    "PullRequestEvent",
    "PullRequestReviewEvent",
    "PullRequestReviewCommentEvent",
    "IssuesEvent",
    "IssueCommentEvent",
)

# Contribution weight per event; every other type weighs 1.
CONTRIBUTION_WEIGHTS = {
    "PullRequestEvent": 10,
    "PullRequestReviewEvent": 8,
    "PushEvent": 5,
    "IssuesEvent": 5,
    "PullRequestReviewCommentEvent": 3,
    "IssueCommentEvent": 2,
    "CreateEvent": 2,
}

# Windows of active users, retention offsets, comeback gap (days).
ACTIVE_WINDOWS = {"wau": 7, "mau": 30}
RETENTION_OFFSETS = (1, 7, 14, 30, 60, 90)
RETURN_GAP_DAYS = 7

# Local time is UTC shifted by this many hours.
KST_OFFSET_HOURS = 9

# Freshness bounds of the event table (days).
FRESH_WARN_DAYS = 2
FRESH_ERROR_DAYS = 7

# Columns of the event table that may not be NULL.
REQUIRED_EVENT_COLUMNS = (
    "id",
    "type",
    "actor",
    "repo",
    "public",
    "created_at",
    "ts_utc",
    "dt_utc",
    "ts_kst",
    "dt_kst",
    "organization",
)

# The sentences of the activity feed.
FEED_PUSH = "{user}이 {repo}:{ref}에 {sha} 푸시: {message}"
FEED_ISSUE_OPENED = "{user}이 이슈 #{number} 생성: {title}"
FEED_ISSUE_CLOSED = "{user}이 이슈 #{number} 종료"
FEED_ISSUE_REOPENED = "{user}이 이슈 #{number} 재오픈"
FEED_ISSUE_OTHER = "{user}이 이슈 #{number} {action}"
FEED_ISSUE_COMMENT = "{user}이 이슈 #{number}에 댓글: {body}"
FEED_PR_OPENED = "{user}이 PR #{number} 생성: {title}"
FEED_PR_MERGED = "{user}이 PR #{number} 병합"
FEED_PR_CLOSED = "{user}이 PR #{number} 종료"
FEED_PR_SYNCHRONIZED = "{user}이 PR #{number} 업데이트"
FEED_PR_OTHER = "{user}이 PR #{number} {action}"
FEED_PR_REVIEW = "{user}이 PR #{number} 리뷰 제출: {state}"
FEED_PR_REVIEW_COMMENT = "{user}이 PR #{number}에 리뷰 댓글: {path}"
FEED_WATCH = "{user}이 {repo}에 Star 추가"
FEED_FORK = "{user}이 {repo}를 {forkee}로 포크"
FEED_MEMBER_ADDED = "{user}이 멤버 {member} 추가"
FEED_MEMBER_REMOVED = "{user}이 멤버 {member} 제거"
FEED_MEMBER_OTHER = "{user}이 멤버 {member} 변경"
FEED_CREATE_REPOSITORY = "{user}이 저장소 생성"
FEED_CREATE_BRANCH = "{user}이 브랜치 {ref} 생성"
FEED_CREATE_TAG = "{user}이 태그 {ref} 생성"
FEED_CREATE_OTHER = "{user}이 항목 {ref} 생성"
FEED_DELETE_BRANCH = "{user}이 브랜치 {ref} 삭제"
FEED_DELETE_TAG = "{user}이 태그 {ref} 삭제"
FEED_DELETE_OTHER = "{user}이 {kind} {ref} 삭제"
FEED_GOLLUM = "{user}이 위키 {title} {action}"
FEED_DEFAULT_ACTION = "업데이트"

# Columns of a digest block, in order.
DIGEST_COLUMNS = (
    "base_date",
    "organization",
    "repo_name",
    "source_event_type",
    "activity_text",
    "actor_login",
)
