"""What each typed event table holds.

Fixed values: column names, their paths in the payload, and types.
"""

from __future__ import annotations

from dataclasses import dataclass

from ..functions.payload import Field


@dataclass(frozen=True)
class EventShape:
    table: str
    event_type: str
    fields: tuple[Field, ...] = ()
    # one output row per element of this payload array, with the element's fields
    items: str | None = None
    item_fields: tuple[Field, ...] = ()
    # boolean columns: name, text column, value it must equal
    flags: tuple[tuple[str, str, str], ...] = ()
    # columns copied under a second name
    copies: tuple[tuple[str, str], ...] = ()


def _fields(text: str) -> tuple[Field, ...]:
    rows = [line.split() for line in text.strip().splitlines()]
    return tuple((name, path, kind) for name, path, kind in rows)


CREATE = EventShape(
    "dl_create_events",
    "CreateEvent",
    fields=_fields(
        """
        created_ref_type  ref_type       string
        created_ref_name  ref            string
        default_branch    master_branch  string
        repo_description  description    string
        pusher_type       pusher_type    string
        """
    ),
    flags=(
        ("is_repo_creation", "created_ref_type", "repository"),
        ("is_branch_creation", "created_ref_type", "branch"),
        ("is_tag_creation", "created_ref_type", "tag"),
    ),
)

DELETE = EventShape(
    "dl_delete_events",
    "DeleteEvent",
    fields=_fields(
        """
        deleted_ref_type  ref_type     string
        deleted_ref_name  ref          string
        pusher_type       pusher_type  string
        """
    ),
    flags=(
        ("is_branch_deletion", "deleted_ref_type", "branch"),
        ("is_tag_deletion", "deleted_ref_type", "tag"),
    ),
)

FORK = EventShape(
    "dl_fork_events",
    "ForkEvent",
    fields=_fields(
        """
        forkee_id              forkee.id              bigint
        forkee_full_name       forkee.full_name       string
        forkee_html_url        forkee.html_url        string
        forkee_owner_login     forkee.owner.login     string
        forkee_owner_id        forkee.owner.id        bigint
        forkee_description     forkee.description     string
        is_fork_private        forkee.private         boolean
        forkee_default_branch  forkee.default_branch  string
        """
    ),
)

GOLLUM = EventShape(
    "dl_gollum_events",
    "GollumEvent",
    items="pages",
    item_fields=_fields(
        """
        page_name      page_name  string
        page_title     title      string
        page_summary   summary    string
        page_action    action     string
        page_sha       sha        string
        page_html_url  html_url   string
        """
    ),
    flags=(
        ("is_page_created", "page_action", "created"),
        ("is_page_edited", "page_action", "edited"),
        ("is_page_deleted", "page_action", "deleted"),
    ),
)

ISSUE_COMMENT = EventShape(
    "dl_issue_comment_events",
    "IssueCommentEvent",
    fields=_fields(
        """
        ic_action           action              string
        issue_number        issue.number        int
        issue_title         issue.title         string
        issue_state         issue.state         string
        issue_html_url      issue.html_url      string
        issue_author_login  issue.user.login    string
        issue_author_id     issue.user.id       bigint
        comment_id          comment.id          bigint
        comment_html_url    comment.html_url    string
        comment_body        comment.body        string
        commenter_login     comment.user.login  string
        commenter_id        comment.user.id     bigint
        """
    ),
)

ISSUES = EventShape(
    "dl_issues_events",
    "IssuesEvent",
    fields=_fields(
        """
        issue_action        action            string
        issue_number        issue.number      int
        issue_title         issue.title       string
        issue_body          issue.body        string
        issue_state         issue.state       string
        issue_html_url      issue.html_url    string
        issue_author_login  issue.user.login  string
        issue_author_id     issue.user.id     bigint
        """
    ),
)

MEMBER = EventShape(
    "dl_member_events",
    "MemberEvent",
    fields=_fields(
        """
        member_login     member.login     string
        member_id        member.id        bigint
        member_html_url  member.html_url  string
        member_action    action           string
        """
    ),
    flags=(
        ("is_member_added", "member_action", "added"),
        ("is_member_removed", "member_action", "removed"),
    ),
)

PULL_REQUEST = EventShape(
    "dl_pull_request_events",
    "PullRequestEvent",
    fields=_fields(
        """
        pr_action              action                         string
        pr_number              pull_request.number            int
        pr_title               pull_request.title             string
        pr_html_url            pull_request.html_url          string
        pr_state               pull_request.state             string
        is_draft               pull_request.draft             boolean
        pr_body                pull_request.body              string
        pr_author_login        pull_request.user.login        string
        pr_author_id           pull_request.user.id           bigint
        head_ref               pull_request.head.ref          string
        base_ref               pull_request.base.ref          string
        head_sha               pull_request.head.sha          string
        base_sha               pull_request.base.sha          string
        commits_count          pull_request.commits           int
        additions              pull_request.additions         int
        deletions              pull_request.deletions         int
        changed_files          pull_request.changed_files     int
        issue_comments_count   pull_request.comments          int
        review_comments_count  pull_request.review_comments   int
        is_merged              pull_request.merged            boolean
        merge_commit_sha       pull_request.merge_commit_sha  string
        """
    ),
)

REVIEW_COMMENT = EventShape(
    "dl_pull_request_review_comment_events",
    "PullRequestReviewCommentEvent",
    fields=_fields(
        """
        pr_review_comment_action  action                          string
        review_comment_id         comment.id                      bigint
        review_comment_html_url   comment.html_url                string
        review_comment_body       comment.body                    string
        diff_hunk                 comment.diff_hunk               string
        file_path                 comment.path                    string
        commit_id                 comment.commit_id               string
        review_id                 comment.pull_request_review_id  bigint
        commenter_login           comment.user.login              string
        commenter_id              comment.user.id                 bigint
        pr_number                 pull_request.number             int
        pr_title                  pull_request.title              string
        pr_html_url               pull_request.html_url           string
        pr_state                  pull_request.state              string
        """
    ),
)

REVIEW = EventShape(
    "dl_pull_request_review_events",
    "PullRequestReviewEvent",
    fields=_fields(
        """
        reviewer_login           review.user.login        string
        reviewer_id              review.user.id           bigint
        review_state             review.state             string
        review_body              review.body              string
        review_html_url          review.html_url          string
        commit_sha               review.commit_id         string
        review_submitted_at_utc  review.submitted_at      string
        pr_number                pull_request.number      int
        pr_title                 pull_request.title       string
        pr_html_url              pull_request.html_url    string
        pr_author_login          pull_request.user.login  string
        """
    ),
    # the submission time is stored as the same text under both names
    copies=(("review_submitted_at_kst", "review_submitted_at_utc"),),
)

PUSH = EventShape(
    "dl_push_events",
    "PushEvent",
    fields=_fields(
        """
        repository_id  repository_id  bigint
        push_id        push_id        bigint
        size           size           int
        distinct_size  distinct_size  int
        ref_full       ref            string
        head_sha       head           string
        before_sha     before         string
        """
    ),
    items="commits",
    item_fields=_fields(
        """
        commit_sha           sha           string
        commit_author_name   author.name   string
        commit_author_email  author.email  string
        commit_message       message       string
        commit_distinct      distinct      boolean
        commit_url           url           string
        """
    ),
)

WATCH = EventShape("dl_watch_events", "WatchEvent")

EVENT_SHAPES = {
    shape.table: shape
    for shape in (
        CREATE,
        DELETE,
        FORK,
        GOLLUM,
        ISSUE_COMMENT,
        ISSUES,
        MEMBER,
        PULL_REQUEST,
        REVIEW_COMMENT,
        REVIEW,
        PUSH,
        WATCH,
    )
}
