"""Redaction of secrets and personal data in a fixed order: secrets first, then addresses, then home paths.

All rules are native expressions. Rules with a decision for each match (keys by entropy, mail by domain, home paths by
name) split the text at its matches and put it together again from kept pieces and judged matches.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lathework.functions.text import shannon_entropy, text_of

# Fixed values that results depend on.
ANTHROPIC_KEY = r"sk-ant-[a-zA-Z0-9_-]{20,}"
AWS_KEY = r"\bAKIA[0-9A-Z]{16}\b"
GITHUB_TOKEN = r"\bgh[pousr]_[A-Za-z0-9]{20,}"
JWT = r"\beyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"
GENERIC_KEY = r"\bsk-([A-Za-z0-9_-]{20,})"
INLINE_CREDENTIAL = r"(?i)\b(sshpass\s+-p|--password[=\s]+|mysql\s+-p|curl\s+-u)\s*['\"]?(?!<[A-Z_]+>)([^'\"\s]{6,})['\"]?"
ID_NUMBER = r"\b[0-9]{17}[0-9xX]\b"
GENERIC_SECRET = r"(?i)\b(token|secret|password|passwd|api_key|apikey|auth_token|access_token|private_key|client_secret)([\"'\s:=]+)([a-zA-Z0-9_.-]{16,})"
PRIVATE_IP = r"\b(?:10\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}|172\.(?:1[6-9]|2[0-9]|3[01])\.[0-9]{1,3}\.[0-9]{1,3}|192\.168\.[0-9]{1,3}\.[0-9]{1,3})\b"
INTERNAL_DOMAIN = r"\b[a-zA-Z0-9-]+\.(?:internal|local|corp|intranet|alibaba-inc|bytedance|meituan)(?:\.[a-zA-Z]{2,})?\b"
MOBILE = r"(?<![0-9.])1[3-9][0-9]{9}(?![0-9.])"
EMAIL = r"\b[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\b"
HOME_PATH = r"(/(?:Users|home))/([A-Za-z0-9._-]+)"
WORD = "[\\p{L}\\p{Nd}_\U00010000]"  # a letter beyond 16 bits makes Java look behind by code points
FIRST = {AWS_KEY: "A", GITHUB_TOKEN: "g", JWT: "e", GENERIC_KEY: "s", ID_NUMBER: "[0-9]", PRIVATE_IP: "1"}
PUBLIC_MAIL = ["gmail.com", "qq.com", "163.com", "126.com", "outlook.com", "hotmail.com", "yahoo.com", "foxmail.com", "icloud.com", "protonmail.com", "github.com", "example.com", "test.com", "localhost", "anthropic.com", "openai.com"]
SYSTEM_NAMES = ["shared", "local", "opt", "usr", "var", "tmp", "root", "runner", "node", "python", "lib", "bin", "etc", "home", "users", "public", "administrator", "default", "linuxbrew"]
HIGH, MEDIUM = "high", "medium"


def edged(pattern: str) -> str:
    """pattern with \\b spelled out: Java's \\b takes a combining mark after a letter for part of a word. Where the first
    character is known, it is looked at first."""
    if pattern in FIRST:
        pattern = f"(?={FIRST[pattern]})(?<!{WORD}){pattern[2:]}"
    return pattern.replace(r"\b", f"(?:(?<!{WORD})(?={WORD})|(?<={WORD})(?!{WORD}))")


def looks_like_real_key(body: Column) -> Column:
    """Long, not hyphenated lower-case words, at least 3.5 bits a character, with a capital or a digit."""
    return (F.length(body) >= 20) & ~body.rlike("^[a-z0-9]+(?:-[a-z0-9]+)+$") & (shannon_entropy(body) >= 3.5) & body.rlike("[A-Z0-9]")


def judged(text: Column, pattern: str, target: Callable[[Column], Column], replacement: Callable[[Column], Column]) -> tuple[Column, Column]:
    """(text, number of replacements): matches that are targets are replaced, others stay."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    new = F.transform(hits, lambda m: F.when(target(m), replacement(m)).otherwise(m))
    joined = F.array_join(F.flatten(F.zip_with(pieces, new, lambda p, m: F.array(F.coalesce(p, F.lit("")), F.coalesce(m, F.lit(""))))), "")
    return joined, F.size(F.filter(hits, target))


def redact_home_paths(text: Column) -> tuple[Column, Column]:
    name = lambda m: F.regexp_extract(m, HOME_PATH, 2)
    personal = lambda m: ~F.lower(name(m)).isin(SYSTEM_NAMES) & ~(name(m).contains(".") & ~name(m).startswith("."))
    return judged(text, HOME_PATH, personal, lambda m: F.concat(F.regexp_extract(m, HOME_PATH, 1), F.lit("/<USER>")))


RULES: list[tuple[str, str, str]] = [
    ("anthropic_key", HIGH, "plain"), ("aws_key", HIGH, "plain"), ("github_token", HIGH, "plain"), ("jwt", HIGH, "plain"),
    ("generic_sk_key", HIGH, "judged"), ("inline_credential", HIGH, "each"), ("id_number", HIGH, "plain"), ("generic_secret", HIGH, "each"),
    ("private_ip", MEDIUM, "plain"), ("internal_domain", MEDIUM, "plain"), ("phone_cn", MEDIUM, "plain"), ("email", MEDIUM, "judged"), ("path_username", MEDIUM, "judged"),
]


def apply_rule(name: str, text: Column) -> tuple[Column, Column]:
    """(text, matches) of one rule."""
    plain = {
        "anthropic_key": (ANTHROPIC_KEY, "sk-ant-<REDACTED>"), "aws_key": (AWS_KEY, "<AWS_KEY_REDACTED>"), "github_token": (GITHUB_TOKEN, "<GH_TOKEN_REDACTED>"),
        "jwt": (JWT, "<JWT_REDACTED>"), "inline_credential": (INLINE_CREDENTIAL, "$1 <CREDENTIAL_REDACTED>"), "id_number": (ID_NUMBER, "<ID_NUMBER>"),
        "generic_secret": (GENERIC_SECRET, "$1$2<REDACTED>"), "private_ip": (PRIVATE_IP, "<INTERNAL_IP>"), "internal_domain": (INTERNAL_DOMAIN, "<INTERNAL_DOMAIN>"), "phone_cn": (MOBILE, "<PHONE>"),
    }
    if name in plain:
        pattern, new = edged(plain[name][0]), plain[name][1]
        return F.regexp_replace(text, pattern, new), F.regexp_count(text, F.lit(pattern))
    if name == "generic_sk_key":
        return judged(text, edged(GENERIC_KEY), lambda m: looks_like_real_key(F.regexp_extract(m, GENERIC_KEY, 1)), lambda m: F.lit("sk-<REDACTED>"))
    if name == "email":
        return judged(text, edged(EMAIL), lambda m: ~F.lower(F.substring_index(m, "@", -1)).isin(PUBLIC_MAIL), lambda m: F.lit("<EMAIL>"))
    return redact_home_paths(text)


def suspicion(name: str, text: Column, low: Column) -> Column:
    """A cheap test that every text with a match passes, so that most texts meet no pattern at all."""
    parts = {
        "anthropic_key": ["sk-ant-"], "aws_key": ["AKIA"], "github_token": ["ghp_", "gho_", "ghu_", "ghs_", "ghr_"], "jwt": ["eyJ"], "generic_sk_key": ["sk-"], "private_ip": ["10.", "172.", "192.168."],
        "internal_domain": [".internal", ".local", ".corp", ".intranet", ".alibaba-inc", ".bytedance", ".meituan"], "email": ["@"], "path_username": ["/Users/", "/home/"],
    }
    folded = {"inline_credential": ["sshpass", "--password", "mysql", "curl"], "generic_secret": ["token", "secret", "password", "passwd", "api_key", "apikey", "private_key"]}
    if name in ("id_number", "phone_cn"):
        return text.rlike("[0-9]{11}")
    out = F.lit(False)
    for part in parts.get(name, ()):
        out = out | F.contains(text, F.lit(part))
    for part in folded.get(name, ()):
        out = out | F.contains(low, F.lit(part))
    return out


def redact(df, text: str = "text"):
    """df with text redacted, hits (array of type, severity, count; one hit for a plain rule, one for each match of the
    others), hit_count and severity (high, medium or null). One projection for each rule bounds the generated code."""
    out = df.withColumn("__t", text_of(F.col(text))).withColumn("__low", F.lower("__t"))
    digits = F.col("__digits")
    out = out.withColumn("__digits", suspicion("id_number", F.col("__t"), F.col("__low")))
    out = out.withColumns({f"__s_{n}": digits if n in ("id_number", "phone_cn") else suspicion(n, F.col("__t"), F.col("__low")) for n, _, _ in RULES}).drop("__low", "__digits")
    for name, _, _ in RULES:
        new, n = apply_rule(name, F.col("__t"))
        maybe = F.col(f"__s_{name}")
        out = out.withColumns({f"__n_{name}": F.when(maybe, n).otherwise(0), "__new": F.when(maybe, new).otherwise(F.col("__t"))}).withColumn("__t", F.col("__new")).drop("__new", f"__s_{name}")
    # a barrier: a later filter on hits must not be pushed into the chain, where it would repeat every rule before it
    out = out.observe(f"redacted-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))
    hits = F.filter(F.array(*(F.struct(F.lit(n).alias("type"), F.lit(s).alias("severity"), F.col(f"__n_{n}").cast("long").alias("count")) for n, s, _ in RULES)), lambda h: h["count"] > 0)
    records = sum((F.when(F.col(f"__n_{n}") > 0, F.lit(1) if kind == "plain" or n == "path_username" else F.col(f"__n_{n}")).otherwise(0) for n, _, kind in RULES), F.lit(0))
    out = out.withColumns({text: F.col("__t"), "hits": hits, "hit_count": records.cast("long")})
    return out.withColumn("severity", worst_severity(F.transform("hits", lambda h: h["severity"]))).drop("__t", *(f"__n_{n}" for n, _, _ in RULES))


def worst_severity(severities: Column) -> Column:
    out = F.lit(None).cast("string")
    for s in ("low", MEDIUM, HIGH):
        out = F.when(F.array_contains(severities, s), s).otherwise(out)
    return out
