"""One query for each redaction rule: every document's text with a match, or a near miss, of the rule behind it."""

from pyspark.sql import functions as F

from lathework.functions import redaction as R
from lathework.plans.registry import literal, query, table

HEX, ID = "md5(CAST(doc_id AS VARCHAR(20)))", "CAST(doc_id AS VARCHAR(20))"
CASES = {
    "anthropic_key": f"concat('sk-ant-', substr({HEX}, 1, CAST(18 + doc_id % 4 AS INT)))",
    "aws_key": f"concat('AKIA', upper(substr({HEX}, 1, CAST(15 + doc_id % 3 AS INT))))",
    "github_token": f"concat('ghp_', substr({HEX}, 1, CAST(18 + doc_id % 4 AS INT)))",
    "jwt": f"concat('eyJ', substr({HEX}, 1, CAST(9 + doc_id % 3 AS INT)), '.', substr({HEX}, 1, 10), '.', substr({HEX}, 5, 12))",
    "generic_sk_key": f"concat('sk-', CASE doc_id % 3 WHEN 0 THEN 'specific-scorer-of-the-registry' WHEN 1 THEN substr({HEX}, 1, 24) ELSE 'ab1ab1ab1ab1ab1ab1ab1ab1' END)",
    "inline_credential": f"concat('sshpass -p ', substr({HEX}, 1, CAST(4 + doc_id % 5 AS INT)))",
    "id_number": f"concat(substr(translate({HEX}, 'abcdef', '123456'), 1, CAST(16 + doc_id % 3 AS INT)), 'X')",
    "generic_secret": f"concat('Password = ', substr({HEX}, 1, CAST(14 + doc_id % 4 AS INT)))",
    "private_ip": f"concat('10.', CAST(doc_id % 300 AS VARCHAR(9)), '.1.2 and 172.', CAST(doc_id % 40 AS VARCHAR(9)), '.0.1')",
    "internal_domain": f"concat('host', {ID}, CASE doc_id % 3 WHEN 0 THEN '.internal' WHEN 1 THEN '.local.net' ELSE '.example' END)",
    "phone_cn": "concat('1', CAST(doc_id % 10 AS VARCHAR(2)), '123456789', CASE WHEN doc_id % 3 = 0 THEN '.5' ELSE '' END)",
    "email": f"concat('u', {ID}, '@', CASE doc_id % 3 WHEN 0 THEN 'gmail.com' WHEN 1 THEN 'corp.example' ELSE 'x' END)",
    "path_username": f"concat('/home/', CASE doc_id % 4 WHEN 0 THEN 'runner' WHEN 1 THEN concat('u', {ID}) WHEN 2 THEN 'a.b' ELSE '.hid' END, '/x')",
}
# DuckDB has no lookaround and its \b knows ASCII letters only, so edges are matched and put back.
A, Z = r"(^|[^\p{L}\p{Nd}_])", r"([^\p{L}\p{Nd}_]|$)"
PLAIN = {
    "anthropic_key": (f"()({R.ANTHROPIC_KEY})()", r"\1sk-ant-<REDACTED>\3"),
    "aws_key": (f"{A}(AKIA[0-9A-Z]{{16}}){Z}", r"\1<AWS_KEY_REDACTED>\3"),
    "github_token": (f"{A}(gh[pousr]_[A-Za-z0-9]{{20,}})()", r"\1<GH_TOKEN_REDACTED>\3"),
    "jwt": (f"{A}({R.JWT[2:]})()", r"\1<JWT_REDACTED>\3"),
    "inline_credential": (f"(?i){A}(sshpass\\s+-p|--password[=\\s]+|mysql\\s+-p|curl\\s+-u)\\s*['\"]?([^'\"\\s]{{6,}})['\"]?", r"\1\2 <CREDENTIAL_REDACTED>"),
    "id_number": (f"{A}([0-9]{{17}}[0-9xX]){Z}", r"\1<ID_NUMBER>\3"),
    "generic_secret": (f"(?i){A}((?:token|secret|password|passwd|api_key|apikey|auth_token|access_token|private_key|client_secret)[\"'\\s:=]+)([a-zA-Z0-9_.-]{{16,}})", r"\1\2<REDACTED>"),
    "private_ip": (f"{A}({R.PRIVATE_IP[2:-2]}){Z}", r"\1<INTERNAL_IP>\3"),
    "internal_domain": (f"{A}({R.INTERNAL_DOMAIN[2:-2]}){Z}", r"\1<INTERNAL_DOMAIN>\3"),
    "phone_cn": (r"(^|[^0-9.])(1[3-9][0-9]{9})([^0-9.]|$)", r"\1<PHONE>\3"),
}
ENTROPY = "list_sum(list_transform(list_distinct(string_split(m, '')), lambda d: -((length(m) - length(replace(m, d, ''))) / length(m)::DOUBLE) * log2((length(m) - length(replace(m, d, ''))) / length(m)::DOUBLE)))"
JUDGED = {
    "generic_sk_key": (f"{A}sk-([A-Za-z0-9_-]{{20,}})", 2, f"length(m) >= 20 AND NOT regexp_matches(m, '^[a-z0-9]+(?:-[a-z0-9]+)+$') AND {ENTROPY} >= 3.5 AND regexp_matches(m, '[A-Z0-9]')"),
    "email": (f"{A}([a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{{2,}})", 2, f"NOT list_contains({literal(R.PUBLIC_MAIL)}, lower(string_split(m, '@')[-1]))"),
    "path_username": ("/(?:Users|home)/([A-Za-z0-9._-]+)", 1, f"NOT list_contains({literal(R.SYSTEM_NAMES)}, lower(m)) AND NOT (contains(m, '.') AND NOT starts_with(m, '.'))"),
}


def sql_of(name: str) -> str:
    src = f"WITH src AS (SELECT doc_id, concat(coalesce(text, ''), ' see ', {CASES[name]}, ' there') AS t FROM documents)"
    if name in PLAIN:
        pattern, new = PLAIN[name]
        return f"{src} SELECT doc_id, len(regexp_extract_all(t, {literal(pattern)}))::BIGINT AS n, md5(regexp_replace(t, {literal(pattern)}, {literal(new)}, 'g')) AS digest FROM src"
    pattern, group, target = JUDGED[name]
    return f"{src} SELECT doc_id, len(list_filter(regexp_extract_all(t, {literal(pattern)}, {group}), lambda m: {target}))::BIGINT AS n FROM src"


def register(number: int, name: str) -> None:
    @query(f"re{number:02d}_{name}", sql_of(name))
    def _(spark, sf):
        text = F.concat(F.coalesce("text", F.lit("")), F.lit(" see "), F.expr(CASES[name]), F.lit(" there"))
        new, n = R.apply_rule(name, F.col("t"))
        out = table(spark, sf, "documents").select("doc_id", text.alias("t")).select("doc_id", n.cast("long").alias("n"), F.md5(new).alias("digest"))
        return out if name in PLAIN else out.drop("digest")


for number, (name, _, _) in enumerate(R.RULES, 1):
    register(number, name)
