"""Category, difficulty and tags of units: weighted wording, corrected by what happened."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathework.functions.paths import BUILD_FILE, is_doc_path, is_test_path
from lathework.functions.text import stripped, text_of

# Fixed values that results depend on.
CATEGORIES = {
    "bug_fix": r"(修复|修一下|修改一下|fix\b|bug|报错|异常|不生效|失效|崩溃|挂了|排查|定位|复现|回归|不работ|没生效|错位|越界|死循环|内存泄漏|debug|broken|crash|regression)",
    "feature_impl": r"(实现|新增|添加|加上|加个|新加|支持|开发|接入|集成|做一个|做个|implement|add\s|create\s|feature|新功能|新接口|新模块)",
    "refactor": r"(重构|重写|拆分|抽取|提取|统一|规范化|简化|收敛|下沉|上提|解耦|refactor|restructure|extract|简化实现|去重复)",
    "test_authoring": r"(写.{0,4}测试|补.{0,4}测试|加.{0,4}测试|单测|测试用例|单元测试|覆盖率|coverage|test\s?case|写个测试|补齐测试)",
    "doc_authoring": r"(写文档|文档|方案|设计稿|readme|写一份|总结|报告|注释|说明书|记录一下|整理成文|design\s?doc|changelog)",
    "code_comprehension": r"(解释|讲讲|是什么|梳理|阅读|研究|评估|对比|讲一下|说明一下|怎么实现|如何工作|原理|为什么这样|理解|explain|understand|how does|what is)",
    "env_ops": r"(部署|构建|打包|依赖|安装|配置|环境|docker|镜像|发布|上线|commit|merge|分支|rebase|ci\b|流水线|pipeline|deploy|build\b)",
}
EXTENSION_TAGS = {
    ".ts": "typescript", ".tsx": "typescript", ".mts": "typescript", ".js": "javascript", ".jsx": "javascript", ".mjs": "javascript", ".vue": "vue", ".py": "python",
    ".sh": "bash", ".bash": "bash", ".md": "markdown", ".yml": "yaml", ".yaml": "yaml", ".json": "json", ".css": "css", ".scss": "css", ".html": "html", ".go": "go",
    ".rs": "rust", ".java": "java", ".sql": "sql",
}
HEAD_CHARS, HEAD_WEIGHT, BODY_WEIGHT, HIT_CAP = 120, 3.0, 1.0, 2


def instruction_head(c: Column) -> Column:
    """The first line, else the start of the text, at most 120 characters."""
    t = text_of(c)
    first = F.substring_index(t, "\n", 1)
    return F.when(stripped(first) != "", F.substring(first, 1, HEAD_CHARS)).otherwise(F.substring(t, 1, HEAD_CHARS))


def category_scores(c: Column) -> Column:
    """Map of categories with wording hits: head counts triple, each part counts at most two hits."""
    head = instruction_head(c)
    body = F.substr(text_of(c), F.length(head) + 1)
    hits = lambda part, p: F.least(F.regexp_count(part, F.lit("(?i)" + p)), F.lit(HIT_CAP))
    scores = F.map_from_arrays(F.array(*(F.lit(n) for n in CATEGORIES)), F.array(*(HEAD_WEIGHT * hits(head, p) + BODY_WEIGHT * hits(body, p) for p in CATEGORIES.values())))
    return F.map_filter(scores, lambda k, v: v > 0)


def boosted(scores: Column, files: Column, edit_ops: Column, tools: Column, n_test_cmds: Column) -> Column:
    """Scores plus what the steps show: only reading, only documents, tests touched, tests run, only build files."""
    low = F.transform(tools, lambda t: F.lower(t))
    some = F.size(files) > 0
    tests = F.exists(files, is_test_path)
    extra = {
        "code_comprehension": F.when((edit_ops == 0) & F.arrays_overlap(low, F.array(*(F.lit(t) for t in ("read", "grep", "glob", "search")))), 1.5).otherwise(0.0),
        "doc_authoring": F.when(some & F.forall(files, is_doc_path), 5.0).otherwise(0.0),
        "test_authoring": F.when(tests, F.when(n_test_cmds >= 3, 6.0).otherwise(4.0)).otherwise(0.0),
        "env_ops": F.when(some & F.forall(files, lambda f: f.rlike(BUILD_FILE)), 4.0).otherwise(0.0),
    }
    more = F.map_from_arrays(F.array(*(F.lit(k) for k in extra)), F.array(*extra.values()))
    total = F.map_zip_with(scores, more, lambda k, a, b: F.coalesce(a, F.lit(0.0)) + F.coalesce(b, F.lit(0.0)))
    return F.map_filter(total, lambda k, v: v > 0)


def pick_category(scores: Column) -> Column:
    """struct of category, confidence and margin to the second; ties by name."""
    entries = F.transform(F.map_entries(scores), lambda e: F.struct((-e["value"]).alias("s"), e["key"].alias("k")))
    ranked = F.array_sort(entries)
    top, second = -F.get(ranked, F.lit(0))["s"], -F.get(ranked, F.lit(1))["s"]
    margin = (top - second) / top
    n = F.size(ranked)
    return F.struct(
        F.when(n == 0, "unclassified").otherwise(F.get(ranked, F.lit(0))["k"]).alias("category"),
        F.when(n == 0, "low").when((n == 1) | (margin >= 0.6), "high").when(margin >= 0.3, "medium").otherwise("low").alias("confidence"),
        F.when(n == 0, 0.0).when(n == 1, 1.0).otherwise(F.round(margin, 3)).alias("margin"),
    )


def difficulty(n_files: Column, edit_ops: Column) -> Column:
    return F.when(edit_ops == 0, "unrated").when((n_files <= 1) & (edit_ops <= 2), "easy").when((n_files <= 2) & (edit_ops <= 6), "medium").otherwise("hard")


def difficulty_basis(edit_ops: Column) -> Column:
    return F.when(edit_ops == 0, "no_edit_ops").otherwise("proxy_editops")


def tags(files: Column, session_steps: Column, error_ops: Column, tools: Column, instruction: Column) -> Column:
    """Sorted distinct tags: languages by extension, and what kind of session it was."""
    pairs = F.create_map(*(F.lit(x) for kv in EXTENSION_TAGS.items() for x in kv))
    languages = F.filter(F.transform(files, lambda f: F.try_element_at(pairs, F.lower(F.regexp_extract(f, r"\.[^.]*$", 0)))), lambda t: t.isNotNull())
    kinds = F.filter(F.array(
        F.when(F.size(F.array_distinct(files)) >= 2, "multi_file"),
        F.when(session_steps >= 50, "long_horizon"),
        F.when(error_ops >= 3, "error_recovery"),
        F.when(F.exists(tools, lambda t: F.lower(t).isin("agent", "task", "subagent")), "sub_agent"),
        F.when(F.length(stripped(instruction)) < 20, "ambiguous_spec"),
    ), lambda t: t.isNotNull())
    return F.array_sort(F.array_distinct(F.concat(languages, kinds)))


def label_units(units: DataFrame) -> DataFrame:
    """units (instruction, files, edit_ops, tools, n_test_cmds, session_steps, error_ops) with all labels."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    scored = units.withColumn("category_scores", category_scores(F.col("instruction")))
    scored = scored.withColumn("category_scores", boosted(F.col("category_scores"), F.col("files"), zero("edit_ops"), F.col("tools"), zero("n_test_cmds")))
    picked = scored.withColumn("p", pick_category(F.col("category_scores")))
    n_files = F.size(F.array_distinct("files"))
    return picked.withColumns({
        "category": F.col("p.category"), "category_confidence": F.col("p.confidence"), "category_margin": F.col("p.margin"), "n_files": n_files.cast("long"),
        "difficulty": difficulty(n_files, zero("edit_ops")), "difficulty_basis": difficulty_basis(zero("edit_ops")),
        "tags": tags(F.col("files"), zero("session_steps"), zero("error_ops"), F.col("tools"), F.col("instruction")),
    }).drop("p")
