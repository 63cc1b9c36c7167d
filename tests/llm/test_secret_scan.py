import hashlib
import random
import re

from tidemark.llm import secret_scan as s

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
KINDS = ["assign", "access", "hex"]


def base(text):
    text = text or ""
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


WEAK = {
    "identifier": re.compile(r"""(access_?key_?id|client_?id|account|user(name)?|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@-]{3,}""", re.I | re.A),
    "opaque": re.compile(r"[A-Za-z0-9+/_-]+"),
    "endpoint": re.compile(r"""(https?|ftp|postgres(ql)?|mysql|mongodb|redis|amqp|s3)://[^\x20\x09-\x0D"'<>]{4,}"""),
}


def all_spans(text):
    """Base spans and completed weak parts, by looking at all pairs."""
    text = text or ""
    parts = base(text)
    for k, (kind, pattern) in enumerate(WEAK.items()):
        for m in pattern.finditer(text):
            if kind != "opaque" or len(m[0]) >= 20 and all(re.search(c, m[0]) for c in ("[0-9]", "[A-Z]", "[a-z]")):
                parts.append((m.start(), 3 + k, kind, m.end()))
    breaks = [m.start() for m in re.finditer(r"\n[\x20\t\r]*\n", text)]
    scope = lambda p: sum(b <= p[0] for b in breaks)
    touch = lambda p, *kinds: any(q[2] in kinds and q[0] < p[3] and p[0] < q[3] for q in parts)
    inside = lambda p: any(q[2] in ("assign", "hex") and q[0] <= p[0] and q[3] >= p[3] for q in parts)
    left = [
        p for p in parts
        if not (p[2] == "identifier" and touch(p, "endpoint")) and not (p[2] == "opaque" and (touch(p, "endpoint", "access", "identifier") or inside(p)))
    ]

    def complete(p):
        near = [q for q in left if scope(q) == scope(p)]
        if p[2] == "identifier":
            return any(q[2] in ("assign", "hex", "opaque") for q in near)
        if p[2] == "opaque":
            return any(q[2] in ("access", "identifier", "endpoint") for q in near)
        if p[2] == "endpoint":
            return any(q[2] == "opaque" or q[2] in ("assign", "hex") and not touch(q, "endpoint") for q in near)
        return True

    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(p for p in left if complete(p)))


def brute(rows):
    out = []
    for r in rows:
        found = base(r.text)
        joined = ",".join(f"{k}:{a}:{b}" for a, _, k, b in found)
        out.append((str(r.doc_id), *[sum(f[2] == k for f in found) for k in KINDS], hashlib.sha256(joined.encode()).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in df.collect())


def scan(spark, *texts):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    return [r.spans for r in s.summarise(docs).orderBy("doc_id").collect()]


def test_same_as_brute_force(spark, odd, nothing):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute(documents.collect())
    assert sum(w[1] + w[3] for w in want) > 10
    assert result(s.summarise(documents)) == want
    assert result(s.summarise(odd)) == brute(odd.collect())
    assert s.summarise(nothing).count() == 0


def test_base_spans_at_the_edges(spark):
    texts = [
        "é token='abcdef' x", "secret=token:abcdefgh", "TOKEN:\n abcdefgh", "password = 12345", "apikey==abc.def", "AKIAAKIA" + "A" * 12 + " AKIA" + "B" * 15,
        "ab" * 12 + "g" + "cd" * 11, "token: " + "a1" * 20, "x" * 50_000 + "passwd:abcdefg" * 300, "api_key\"  :  \"" + "0" * 30, "AKIA" * 30,
    ]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    assert result(s.summarise(docs)) == brute(docs.collect())


def test_weak_parts_need_their_complement(spark):
    name, value, place = "client_id = app-7", "Zx9" + "aB3" * 8, "https://api.example.com/v1"
    assert scan(spark, name, value, place, f"{name}\n\n{value}", f"{place}\n \n{value}", f"{place} {name}") == [""] * 6
    linked = scan(spark, f"{name}\n{value}\n{place}", f"{place} token = abcdef99", f"AKIA{'Q' * 16} {value}", f"{value} {place}")
    assert linked[0] == f"identifier:0:17,opaque:18:45,endpoint:46:{46 + len(place)}"
    assert [x.split(":")[0] for x in linked[1].split(",")] == ["endpoint", "assign"]
    assert [x.split(":")[0] for x in linked[2].split(",")] == ["access", "opaque"]
    assert linked[3] == f"opaque:0:27,endpoint:28:{28 + len(place)}"


def test_distance_does_not_part_them(spark):
    name, long = "client_id = app-7", "aB3_" * 120
    far = f"{name} {'y ' * 3000} Zx9{'aB3' * 8}"
    got = scan(spark, f"{long} {name}", far)
    assert got[0] == f"opaque:0:480,identifier:481:498" and got[1] == all_spans(far) and got[1].count(":") == 4


def test_parts_of_a_part_do_not_complete_it(spark):
    commit = "see https://example.com/Org/repo1/commit/4f9aB2cD8eF0aB2cD8eF0 for that"
    own = "client_id = aB3aB3aB3aB3aB3aB3aB3"
    inner = "https://example.com/?token=abcdef99"
    assert scan(spark, commit, own, inner) == ["", "", "assign:21:35"]
    assert scan(spark, f"{inner} and token: zyxwvu11")[0] == "endpoint:0:35,assign:21:35,assign:40:55"


def test_linked_spans_same_as_brute_force(spark, odd):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    draw = random.Random(8)
    pieces = [
        "client_id = app-7", "user: Bob@example.org", "Zx9" + "aB3" * 8, "q_" + "0f" * 13 + "Z", "https://api.example.com/v1", "https://h.org/?user=abc&token=abcdef99",
        "token = abcdef99", "AKIA" + "Q" * 16, "xAKIA" + "Q" * 16 + "z", "0f" * 14, "login=https://x.example/aB3aB3aB3aB3aB3aB3aB3aB3", "plain", "é日", "\n", "\n\n", " \n \t\n ", "s3://bucket/Key9" + "a" * 20,
        "password=" + "aB3" * 9, "account: " + "aB3" * 9,
    ]
    texts = ["".join(draw.choice(pieces) + draw.choice(["", " ", " ", ", "]) for _ in range(draw.randrange(1, 14))) for _ in range(600)]
    rows = [(k, t) for k, t in enumerate([*texts, *(r.text for r in documents.collect()), *(r.text for r in odd.collect())])]
    got = s.summarise(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = {k: all_spans(t) for k, t in rows}
    assert sum(w.count("identifier") + w.count("opaque") > 0 for w in want.values()) > 100
    assert [(r.doc_id, r.spans) for r in got if r.spans != want[r.doc_id]] == [] and len(got) == len(rows)


def test_redact(spark, odd):
    docs = spark.createDataFrame([(1, "é token=abcdef1 and " + "0f" * 14 + "!"), (2, None), (3, "plain"), (3, "token='" + "ab" * 20 + "'"), (3, "token='" + "ab" * 20 + "'")], "doc_id long, text string")
    got = sorted((r.doc_id, r.text or "") for r in s.redact(docs).collect())
    assert got == [(1, "é [secret] and [secret]!"), (2, ""), (3, "[secret]'"), (3, "[secret]'"), (3, "plain")]
    assert s.redact(odd).count() == odd.count() and s.redact(odd).columns == odd.columns
