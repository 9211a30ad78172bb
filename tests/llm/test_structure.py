"""Personal data, conversations and manifests against plain versions."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from plumbline.llm import conversation_repair, merkle, pii

SPACE = " \t\n\x0b\x0c\r"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def tables(tmp_path, **frames):
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


# ------------------------------------------------------------------ 11

EMAIL, IP, CARD, PHONE = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([ -]?[0-9])+", r"\+[0-9][ ().0-9-]+[0-9]"


def luhn(digits):
    doubled = [int(c) if i % 2 == 0 else 2 * int(c) - 9 * (c > "4") for i, c in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def base_spans(text):
    digits = lambda v: re.sub("[^0-9]", "", v)
    tests = [
        (EMAIL, lambda v: True),
        (IP, lambda v: all(int(x) <= 255 for x in v.split("."))),
        (CARD, lambda v: 14 <= len(digits(v)) <= 19 and luhn(digits(v))),
        (PHONE, lambda v: 10 <= len(digits(v)) <= 15),
    ]
    found = [(m.start(), n, m.end()) for n, (p, ok) in enumerate(tests) for m in re.finditer(p, text or "") if ok(m.group())]
    return [f"{pii.KINDS[n]}:{s}:{e}" for s, n, e in sorted(found)]


def scanned(df):
    found = pii.scan(df)
    return {r.doc_id: [f"{s.kind}:{s.start}:{s.end}" for s in r.spans] for r in found.collect()}


def test_base_spans_equal_the_stated_patterns(spark):
    rng = random.Random(11)
    pieces = ["a", "b@c", ".", "..", "@", "-", " ", "  ", "+", "+1", "5", "12", "255", "256", "0001", "(", ")", "%", "_", "é", "😀", "\n", "4111 1111 1111 1111", "4111-1111-1111-1111", "+1 (212) 555-0199", "10.0.0.1", "x.y@z.co.uk", "a@b.c"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 40))) for _ in range(1500)]
    texts += [None, "", "a@b.c..d", "a@b.c.", "a@b.c@d.e", "a@b.c%x@d.e", "1.2.3.4.5.6.7.8", "999.1.2.3.4", "+1.2.3.4.5.6.7.8.9.0.1"]
    got = scanned(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    for i, t in enumerate(texts):
        assert [s for s in got[i] if "_like" not in s] == base_spans(t), t


def test_long_runs_take_linear_time_and_no_stack(spark):
    n = 60_000
    texts = ["a" * n, "a@b" + ".c" * n, "1 " * n, "1-" * n + "1", "1." * n, "+" * n, "+1" + " " * n, "@" * n, "a." * n + "@", "x1" * n]
    got = scanned(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert got[1] == [f"email:0:{3 + 2 * n}"]
    assert got[4] == [f"ip:{8 * i}:{8 * i + 7}" for i in range(n // 4)]
    assert sum(map(len, got.values())) == 1 + n // 4


def test_confident_contexts_find_unseen_identifiers(spark):
    rng = random.Random(3)
    number = lambda: f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
    texts = [f"Please call me at {number()} before noon" for _ in range(12)]
    texts += [f"write to user mail{i}x@example.org today" for i in range(12)]
    unseen = ["Please call me at 212 555 7788 before noon", "write to user jane_doe42 today", "we sold 123456 units", "code ab12cd is fine"]
    copies = [unseen[0]] * 40
    got = scanned(spark.createDataFrame(list(enumerate(texts + unseen + copies)), "doc_id long, text string"))
    at = len(texts)
    assert got[at] == ["phone_like:18:30"] and got[at + 1] == ["email_like:14:24"]
    assert got[at + 2] == [] and got[at + 3] == []
    assert all(got[at + 4 + i] == got[at] for i in range(40))
    assert all(len(got[i]) == 1 for i in range(at))


def test_mixed_contexts_find_nothing(spark):
    """A context that several kinds share, or that few seeds support, is not confident."""
    texts = [f"see the {v} there" for v in ("10.0.0.1", "10.0.0.2", "a@b.co", "c@d.co", "+1 212 555 0199", "+1 212 555 0198", "7654321")]
    texts += ["ring now +1 212 555 0123 ok", "ring now +1 212 555 0124 ok", "ring now 7654329 ok"]
    assert not any("_like" in s for spans in scanned(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).values() for s in spans)


def test_personal_data_at_the_edges(spark):
    rows = [(1, "a@b.co"), (1, "a@b.co"), (None, "a@b.co"), (2, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("row", "email", "mixed", "spans", "base", "email_m", "value", "start")})
    found = sorted((r.doc_id or 0, len(r.spans)) for r in pii.scan(df).collect())
    assert found == [(0, 1), (1, 1), (1, 1), (2, 0), (3, 0)]
    assert pii.scan(df.limit(0)).count() == 0


# ------------------------------------------------------------------ 12

ROLES = {"": "su", "s": "u", "u": "a", "a": "u"}


def damaged(rows):
    out = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        order = (t is not None, t or 0, r, hashlib.sha256(x.encode()).hexdigest())
        out += [(c, (*order, k), t, "user" if kind == 4 else r, text) for k in range(0 if kind == 0 else 2 if kind == 3 else 1)]
    return out


def repaired(rows):
    """Least cost, then least edit string, by search over (place, state)."""
    convs = {r[0]: [] for r in rows}
    for c, order, *turn in damaged(rows):
        convs[c].append((order, turn))
    out = {}
    for c, items in convs.items():
        turns = [t for _, t in sorted(items, key=lambda i: i[0])]
        seen, faults = set(), []
        for _, r, x in turns:
            faults.append("blank" if not x.strip(SPACE) else "duplicate" if (r, x) in seen else "truncated" if x.rstrip(SPACE)[-1] not in ".!?" else None)
            seen.add((r, x))
        heap, done = [(0, "", 0, "", ())], set()
        while True:
            cost, audit, i, q, text = heapq.heappop(heap)
            if i == len(turns) and q in ("", "a"):
                break
            if (i, q) in done:
                continue
            done.add((i, q))
            for role in ("user", "assistant"):
                if role[0] in ROLES[q]:
                    heapq.heappush(heap, (cost + 2, audit + "I", i, role[0], (*text, f"{role}:")))
            if i == len(turns):
                continue
            _, r, x = turns[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, q, text))
            if faults[i] in (None, "truncated"):
                more = faults[i] == "truncated"
                if r and r[0] in ROLES[q]:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, r[0], (*text, f"{r}:{x}")))
                for role in ("user", "assistant"):
                    if role[0] in ROLES[q]:
                        heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, role[0], (*text, f"{role}:{x}")))
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        out[c] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(text).encode()).hexdigest())
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@pytest.mark.parametrize("block", [8192, 3])
def test_repaired_conversations(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(conversation_repair, "BLOCK", block)
    rng = random.Random(block)
    rows = []
    for c in [*range(120), None]:
        n = 400 if c == 7 else rng.randint(1, 9)  # one conversation holds a third of all turns
        for t in range(n):
            number = rng.choice([t, t, t, t, t // 2, t * 3, None])
            rows.append((c, number, rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "User"]), rng.choice(["Yes.", "No!", "so?", "cut", " ", "", "\n\t", None, "é.", f"t{t} ok.", f"t{t} ok. \n", "a\nb."])))
    at = tables(tmp_path, conversations=spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"key": F.lit(1), "pos": F.lit("x"), "size": F.lit(0), "kind": F.lit(0)}))
    got = {r.conv_id: tuple(r[k] for k in COLUMNS) for r in conversation_repair.op12_conversation_repair(spark, at).collect()}
    want = repaired(rows)
    assert got.keys() == want.keys()
    for c in want:
        assert got[c] == want[c], c


def test_no_conversations(spark, tmp_path):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_repair.op12_conversation_repair(spark, tables(tmp_path, conversations=empty)).count() == 0


def test_repaired_turns_follow_the_grammar(spark):
    rows = [(1, t, r, "ok.") for t, r in enumerate(["assistant", "user", "user", "system", "assistant"])]
    turns, found = conversation_repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    roles = [role for r in sorted(turns.collect(), key=lambda r: r.pos) for role in r.roles]
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r in roles))
    assert found.first().cost > 0


# ------------------------------------------------------------------ 13


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + 16])) for i in range(0, len(below), 16)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        run = level[i // 16 * 16 : i // 16 * 16 + 16]
        out.append((run[: i % 16], run[i % 16 + 1 :]))
        i //= 16
    return out


def manifest(rows):
    leaf = lambda r, text: sha("".join(field(v) for v in (r[0], r[3], r[2], r[4], text)))
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda g: g[:3])
        trees[s] = tree([g[2] for g in groups[s]])
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, (_, _, d, r) in enumerate(groups[s]):
            path = siblings(trees[s], i) + siblings(top, k)
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None
            fold = leaf(r, re.sub("[A-Z]", lambda m: m.group().lower(), r[1])) if tampered else d
            for left, right in path:
                fold = sha("".join([*left, fold, *right]))
            out.append((r[0], d, trees[s][-1][0], top[-1][0], sha("".join("".join(a + b) for a, b in path)), fold, fold == top[-1][0]))
    return sorted(out, key=str)


NAMES = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def found(spark, at):
    return sorted((tuple(r[k] for k in NAMES) for r in merkle.op13_merkle_manifest(spark, at).collect()), key=str)


@pytest.mark.parametrize("sizes", [[1], [16], [17, 1, 257], [3] * 40 + [300]])
def test_manifest(spark, tmp_path, sizes):
    rng = random.Random(len(sizes))
    rows, n = [], 0
    for k, size in enumerate(sizes):
        for _ in range(size):
            rows.append((n, rng.choice(["Text A", "lower", "", None, "É z"]) if n % 7 else "X" * n, rng.choice(["en", None]), None if k == 0 else f"sé{k}", rng.choice([None, n])))
            n += rng.choice([1, 1, 1, 13])
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("c") for c in ("grp", "idx", "digest", "kids", "altered", "trail")})
    assert found(spark, tables(tmp_path, documents=df.repartition(7))) == manifest(rows)


def test_manifest_of_repeated_rows_and_null_ids(spark, tmp_path):
    rows = [(1, "A", "en", "s", 1)] * 40 + [(1, "B", "en", "s", 1), (None, "C", None, "s", None), (None, None, None, None, None)] + [(i, "d", "x", "t", 2) for i in range(20)]
    assert found(spark, tables(tmp_path, documents=spark.createDataFrame(rows, DOCS))) == manifest(rows)


def test_manifest_of_no_rows(spark, tmp_path):
    assert found(spark, tables(tmp_path, documents=spark.createDataFrame([], DOCS))) == []


def test_partial_parents_meet_in_any_order():
    """Leaves dealt to tasks at random: what is unresolved is merged until one root stands."""
    import pyarrow as pa

    digests = [sha(str(i)) for i in range(700)]
    events = [{"grp": "g", "size": 700, "level": 1, "idx": i // 16, "kids": [{"place": i % 16, "digest": d, "doc_id": i, "altered": None}]} for i, d in enumerate(digests)]
    rng, nodes = random.Random(5), []
    while events:
        rng.shuffle(events)
        step = max(1, len(events) // 5)
        made = [r for i in range(0, len(events), step) for b in merkle._combine([pa.RecordBatch.from_pylist(events[i : i + step])]) for r in b.to_pylist()]
        nodes += [r for r in made if r["kind"] < 2]
        events = [r for r in made if r["kind"] == 2]
        by_key = {}
        for r in events:
            by_key.setdefault((r["grp"], r["level"], r["idx"]), {**r, "kids": []})["kids"].extend(r["kids"])
        events = list(by_key.values())
    assert [r["digest"] for r in nodes if r["kind"] == 1] == tree(digests)[-1]
    assert sum(r["kind"] == 0 for r in nodes) == sum(len(x) for x in tree(digests)[1:])
