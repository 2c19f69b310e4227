"""Predicates and transformations of instruction and prompt texts. Column in, Column out; null counts as empty."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results depend on.
NOISE_TAGS = ["system-reminder", "local-command-stdout", "local-command-caveat", "local-command-stderr", "command-name", "command-message", "command-args", "task-notification", "available-deferred-tools"]
NOISE_PREFIXES = ["[SUGGESTION MODE", "The user stepped away", "Caveat:", "A session-scoped Stop hook is now active", "Describe your most recent action", "Based on the conversation transcript above", "Another Claude session sent a message", "[SYSTEM NOTIFICATION"]
FOLLOWUP_WORDS = ["继续", "接着", "还有", "不对", "再改", "这个", "那个", "然后", "为什么", "为啥", "不行", "还是", "改一下", "再来", "重新", "试试", "好的", "嗯", "ok", "okay", "continue", "go on", "next", "again", "why", "hmm"]
FOLLOWUP_ALWAYS = ["继续", "接着", "重新", "continue", "go on"]
TASK_VERBS = (
    "实现|新增|添加|加上|修复|修改|改成|重构|优化|删除|移除|清理|分析|排查|调查|检查|审查|评审|设计|规划|梳理|整理|写|编写|补全|补充|生成|创建|新建|部署|发布|升级|迁移|测试|验证|跑一下|执行|实施|开始|完成|处理|解决|支持|重命名|拆分|合并|替换|统一|对齐|"
    "implement|add|create|fix|refactor|optimi[sz]e|remove|delete|analy[sz]e|investigate|review|design|write|generate|deploy|upgrade|migrate|test|verify|split|merge|rename|replace|support"
)
ERROR_LOG = r"(?m)(Traceback \(most recent call last\)|^\s*at .+:[0-9]+:[0-9]+|\bError:|\bERR!|\bException\b|error TS[0-9]+|FAIL\s|✗|failed with exit code)"
POLITE = r"^\s*(请你?|帮我|麻烦你?|你|能不能|可以)\s*"
COMMAND_ARGS = r"(?s)<command-name>\s*(.*?)\s*</command-name>.*?<command-args>\s*(.*?)\s*</command-args>"
WRAPPED = r"(?is)^\s*<(session|conversation)>\s*(.*?)\s*(?:</\1>)?\s*$"
INJECTED_MARKS = ["user's CLAUDE.md configuration", "Contents of /", "Continue from where you left off"]
REPLAYED = r"^\s*(?:Agent\s*\([^)]{1,40}\)|User|Assistant|Human)\s*:\s"
SLASH_BODY = r"当用户调用\s*`?/[a-zA-Z0-9_-]"
TEST_COMMAND = r"\b(bun\s+test|vitest|jest|pytest|py\.test|go\s+test|cargo\s+test|npm\s+(?:run\s+)?test|pnpm\s+(?:run\s+)?test|yarn\s+test|make\s+(?:test|lint|build|check)|oxlint|eslint|ruff\s+check|alembic\s+check|format:check|lint:boundary|docs:lint|docs:index-check|tsc\b)"
VENDORS = [("claude", "anthropic"), ("deepseek", "deepseek"), ("gpt", "openai"), ("o1", "openai"), ("o3", "openai"), ("glm", "zhipu"), ("qwen", "alibaba"), ("kimi", "moonshot"), ("grok", "xai"), ("gemini", "google"), ("doubao", "bytedance")]
ANSWER_KEYS = ["tool_result_content", "response_content", "patch_content", "observation_content", "completion_text"]
BOUNDARY_CONFIDENCE = {"B_FIRST": "high", "B_TIME_GAP": "high", "B_FILE_DISJOINT": "high", "B_TASK_PATTERN": "medium"}
FOLLOWUP_SHORT, TASK_LONG, ARGS_LONG = 20, 40, 15
FENCE_MARK = "（此处原有一段代码块，评测题面已移除。）"
PROMPT_MARKS = ["<system-reminder>", "<local-command", "<command-name>", "[SUGGESTION MODE", "The user stepped away", "Caveat:"]
WORKING_DIRECTORY = r"(?:Primary working directory|Working directory|Current working directory)\s*[:=]\s*(/[^\n\"\\'`]+?)\s*\n"


def text_of(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def stripped(c: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text_of(c), r"^\s+|\s+$", "")


def starts_with_any(c: Column, prefixes: Sequence[str]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | c.startswith(p)
    return out


def normalize_vendor(model: Column) -> Column:
    """The first matching name part decides; unknown without one."""
    low, out = F.lower(text_of(model)), F.lit("unknown")
    for part, vendor in reversed(VENDORS):
        out = F.when(low.contains(part), vendor).otherwise(out)
    return out


def agent_source(sid: Column, tool_source: Column, own_tool: str = "own-cli", own_name: str = "own_cli") -> Column:
    """Capture channel by the shape of a session id."""
    return (
        F.when(F.lower(text_of(tool_source)) == own_tool, own_name)
        .when((F.length(sid) == 36) & (F.regexp_count(sid, F.lit("-")) == 4), "claude_code")
        .when(sid.rlike("^[0-9]{8}"), "codex")
        .otherwise("short_id")
    )


def provenance(git_state: Column, git_head: Column) -> Column:
    """Whether a session is anchored in version control; empty counts as missing."""
    return F.when((text_of(git_state) != "") | (text_of(git_head) != ""), "anchored").otherwise("unanchored")


def is_noise(c: Column) -> Column:
    t = text_of(c)
    tagged = t.rlike(r"(?i)^\s*<(" + "|".join(NOISE_TAGS) + r")\b")
    return (stripped(t) == "") | tagged | starts_with_any(F.regexp_replace(t, r"^\s+", ""), NOISE_PREFIXES)


def unwrap_user_text(c: Column) -> Column:
    """The inside of a session or conversation tag."""
    return F.when(text_of(c).rlike(WRAPPED), F.regexp_extract(c, WRAPPED, 2)).otherwise(c)


def has_task_verb(c: Column) -> Column:
    return text_of(c).rlike("(" + TASK_VERBS + ")")


def command_args(c: Column) -> Column:
    """Arguments of slash commands that read like tasks."""
    found = F.transform(F.regexp_extract_all(text_of(c), F.lit(COMMAND_ARGS), F.lit(2)), stripped)
    return F.filter(found, lambda a: (F.length(a) >= ARGS_LONG) & has_task_verb(a) & ~is_noise(a))


def strip_polite(c: Column) -> Column:
    return stripped(F.regexp_replace(text_of(c), POLITE, ""))


def looks_like_followup(c: Column) -> Column:
    """Short texts that open with a follow-up word, texts that ask to go on, and pasted error logs."""
    t = strip_polite(c)
    low = F.lower(t)
    return ((F.length(t) < FOLLOWUP_SHORT) & starts_with_any(low, FOLLOWUP_WORDS)) | starts_with_any(low, FOLLOWUP_ALWAYS) | t.rlike(ERROR_LOG)


def is_injected_prompt(c: Column) -> Column:
    head = F.substring(text_of(c), 1, 400)
    marked = F.lit(False)
    for m in INJECTED_MARKS:
        marked = marked | F.substring(head, 1, 150).contains(m)
    return F.substring(head, 1, 60).contains("[Request interrupted") | head.rlike(REPLAYED) | marked | head.rlike(SLASH_BODY)


def looks_like_task_start(c: Column) -> Column:
    t = stripped(c)
    return (F.length(t) >= TASK_LONG) & has_task_verb(t)


def user_text_blocks(blocks: Column) -> Column:
    """Real user texts among text blocks: noise gives its command arguments, wrapped text its inside, injected text nothing."""
    def real(t: Column) -> Column:
        inside = unwrap_user_text(t)
        keep = (stripped(inside) != "") & ~is_noise(inside) & ~is_injected_prompt(inside)
        return F.when(is_noise(t), command_args(t)).when(keep, F.array(inside)).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.transform(blocks, real))


def boundary_confidence(reason: Column) -> Column:
    out = F.lit("low")
    for name, level in BOUNDARY_CONFIDENCE.items():
        out = F.when(reason == name, level).otherwise(out)
    return out


def test_commands(command: Column, first_word: bool = False) -> Column:
    """Test and gate commands in a shell line; by first word or by whole match."""
    found = F.regexp_extract_all(text_of(command), F.lit(TEST_COMMAND), F.lit(1))
    return F.transform(found, lambda m: F.regexp_extract(m, r"^\S+", 0)) if first_word else found


def strip_fenced_blocks(c: Column) -> Column:
    """Every fenced block becomes one line; an open fence reaches to the end."""
    return F.regexp_replace(text_of(c), r"(?m)^[ \t]*```[^\n]*(?:\n(?![ \t]*```)[^\n]*)*+(?:\n[ \t]*```[^\n]*)?", FENCE_MARK)


def visible_controls(c: Column) -> Column:
    """C0 controls but tab, line feed and carriage return as \\xNN."""
    out = c
    for i in [*range(1, 9), 11, 12, *range(14, 32)]:
        out = F.replace(out, F.lit(chr(i)), F.lit(f"\\x{i:02x}"))
    return out


def gold_candidates(diff: Column, least: int = 25) -> Column:
    """Distinct added lines of a diff that are long enough and no comments, sorted."""
    lines = F.filter(F.split(text_of(diff), "\n"), lambda x: x.startswith("+") & ~x.startswith("+++"))
    lines = F.transform(lines, lambda x: stripped(F.substring(x, 2, 1 << 30)))
    return F.array_sort(F.array_distinct(F.filter(lines, lambda x: (F.length(x) >= least) & ~starts_with_any(x, ["*", "//", "/*"]))))


def normalize_patch(c: Column) -> Column:
    """LF line ends and a final line feed."""
    t = F.regexp_replace(text_of(c), "\r\n|\r", "\n")
    return F.when(t.endswith("\n"), t).otherwise(F.concat(t, F.lit("\n")))


def strip_line_numbers(c: Column, share: float = 0.8) -> Column:
    """Without `   12→` style numbers if at least this share of the lines has one."""
    mark = r"^\s*[0-9]+(→|\t)"
    lines = F.split(text_of(c), "\n")
    numbered = F.size(F.filter(lines, lambda x: x.rlike(mark)))
    bare = F.array_join(F.transform(lines, lambda x: F.regexp_replace(x, mark, "")), "\n")
    return F.when(numbered >= share * F.size(lines), bare).otherwise(c)


def quoted_paths(c: Column) -> Column:
    """Distinct paths in quotes or backticks, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text_of(c), F.lit("[\"'`]([A-Za-z0-9_./-]+\\.[A-Za-z0-9]+)[\"'`]"), F.lit(1))))


def task_kind(diff: Column) -> Column:
    """test_change if the diff touches a test file."""
    files = F.regexp_extract_all(text_of(diff), F.lit(r"(?m)^diff --git a/(\S+)"), F.lit(1))
    return F.when(F.exists(files, lambda f: f.contains(".test.") | f.contains("/tests/")), "test_change").otherwise("source_change")


def answer_key_hits(c: Column) -> Column:
    """keyword@line:N for every line with a key under which recorded answers are stored."""
    lines = F.split(text_of(c), "\n")
    per_line = F.transform(lines, lambda x, i: F.filter(F.array(*(F.when(x.contains(k), F.concat(F.lit(f"{k}@line:"), (i + 1).cast("string"))) for k in ANSWER_KEYS)), lambda h: h.isNotNull()))
    return F.flatten(per_line)


def first_prompt(blocks: Column) -> Column:
    """The first block that is no system tag and longer than 10, else the first."""
    good = F.filter(blocks, lambda t: ~starts_with_any(stripped(t), PROMPT_MARKS) & (F.length(stripped(t)) > 10))
    return F.coalesce(F.get(good, F.lit(0)), F.get(blocks, F.lit(0)))


def shannon_entropy(c: Column) -> Column:
    """Bits per character; 0 for an empty text. Characters are counted in order of their first occurrence."""
    t = text_of(c)
    chars = F.filter(F.array_distinct(F.split(t, "")), lambda x: x != "")
    n = F.length(t).cast("double")
    share = lambda d: (F.length(t) - F.length(F.replace(t, d, F.lit("")))) / n
    return F.aggregate(chars, F.lit(0.0), lambda a, d: a - share(d) * F.log2(share(d)))


def redact_to_fixpoint(c: Column, pattern: str, replacement: str, rounds: int = 3) -> Column:
    """Replaces until nothing is left, at most `rounds` times."""
    out = c
    for _ in range(rounds):
        out = F.regexp_replace(out, pattern, replacement)
    return out


def working_directories(c: Column) -> Column:
    """Declared working directories; a name may hold spaces, so a line end closes it."""
    return F.regexp_extract_all(text_of(c), F.lit(WORKING_DIRECTORY), F.lit(1))
