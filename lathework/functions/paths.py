"""Predicates on repository paths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results depend on.
TEST_PATH = r"(?i)(^|/)(tests?|__tests__|spec)/|\.(test|spec)\.[a-z]+$"
DOC_PATH = r"(?i)\.(md|mdx|rst|txt)$"
TEST_FILE_MARKS = [".test.", ".spec.", "_test_", "_spec_"]
BUILD_FILE = r"(?i)(package\.json|pyproject\.toml|Dockerfile|\.ya?ml|\.config\.[jt]s|Makefile|requirements\.txt)$"
BENIGN_LEAKS = [
    ("skill_baseline", r"^/repo/(src|packages)/[^/]*/?skill/builtin/[^/]+/evals(/|$)"),
    ("workspace_anchor", r"^/repo/packages/eval-framework/package\.json$"),
    ("external_stub", r"^/eval-framework(/|$)"),
    ("linked_stub", r"^/repo/node_modules/eval-framework(/|$)"),
    ("base_image", r"^/(usr|lib|bin|sbin|etc|opt|var/lib/(apt|dpkg))/"),
]
WORKTREE = "/.claude/worktrees/"


def under_any(path: Column, prefixes: Sequence[str]) -> Column:
    """Equal to a prefix or below it, by whole path segments."""
    rel = F.regexp_replace(path, "^/+", "")
    out = F.lit(False)
    for p in prefixes:
        out = out | (rel == p.rstrip("/")) | rel.startswith(p.rstrip("/") + "/")
    return out


def repo_of(path: Column, root: str, repos: Sequence[str]) -> Column:
    """The longest known repository that holds the path; worktrees count for their host; null if none."""
    bare = F.substring_index(F.regexp_replace(path, "/+$", ""), WORKTREE, 1)
    rel = F.when(bare.startswith(root), F.substring(bare, len(root) + 1, 1 << 30))
    out = F.lit(None).cast("string")
    for r in sorted(repos, key=lambda r: (len(r), r)):
        out = F.when((rel == r) | rel.startswith(r + "/"), r).otherwise(out)
    return out


def relative_path(path: Column, root: str, repo: Column) -> Column:
    """The path below its repository, or null."""
    base = F.concat(F.lit(root), repo, F.lit("/"))
    return F.when(F.startswith(path, base), F.substr(path, F.length(base) + 1))


def is_test_path(path: Column) -> Column:
    return path.rlike(TEST_PATH)


def is_doc_path(path: Column) -> Column:
    return path.rlike(DOC_PATH)


def is_test_file(path: Column) -> Column:
    """The name holds one of the test runner's marks."""
    name, out = F.substring_index(path, "/", -1), F.lit(False)
    for m in TEST_FILE_MARKS:
        out = out | name.contains(m)
    return out


def classify_leak(path: Column) -> Column:
    """The first benign pattern that fits, else violation."""
    out = F.lit("violation")
    for name, pattern in reversed(BENIGN_LEAKS):
        out = F.when(path.rlike(pattern), name).otherwise(out)
    return out


def classify_dropped(path: Column, root: str, repo: Column) -> Column:
    host = F.concat(F.lit(root), repo)
    return (
        F.when(F.startswith(path, F.concat(host, F.lit(WORKTREE))), "same_repo_worktree")
        .when(path.startswith(root), "cross_repo")
        .otherwise("out_of_scope")
    )


def is_doc_file(path: Column) -> Column:
    """Below docs/ or a markdown file: left out of code patches."""
    return path.startswith("docs/") | path.endswith(".md")


def kept_in_snapshot(path: Column, prefixes: Sequence[str], files: Sequence[str], exempt: Sequence[str] = ()) -> Column:
    """False for what lies below a leaking prefix at the top, or is a leaking file; exempt paths stay."""
    return path.isin(*exempt) | ~(under_any(path, prefixes) | path.isin(*files)) if exempt else ~(under_any(path, prefixes) | path.isin(*files))


def round_trips(absolute: Column, relative: Column, root: str, repo: Column) -> Column:
    """Whether root, repository and relative path give the absolute path again."""
    return F.coalesce(F.concat(F.lit(root), repo, F.lit("/"), relative) == absolute, F.lit(False))


def relative_in_known(path: Column, root: str, repos: Sequence[str]) -> Column:
    """The path below the longest known repository, or null."""
    return relative_path(F.substring_index(path, WORKTREE, 1), root, repo_of(path, root, repos))
