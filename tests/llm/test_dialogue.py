import hashlib
import random
import re
import zlib

import pytest

from urbanlens.llm import dialogue

TURNS = "conv_id long, turn long, role string, text string"


def plain(rows):
    """Digest of one conversation, (turn, role, text) in order, by a forward search over (cost, edits)."""
    seen, faults = set(), []
    for _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        faults.append("B" if not body else "D" if (role, text) in seen else "T" if body[-1] not in ".!?" else "K")
        seen.add((role, text))
    best = {"": (0, "", [])}  # by what of (s?(ua)+)? the roles so far leave open

    def follow(state, c):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, c))

    def insert(best):
        for _ in range(3):
            for q, (cost, edits, out) in list(best.items()):
                for name in ("user", "assistant"):
                    to = follow(q, name[0])
                    if to:
                        best[to] = min(best.get(to, (10**9,)), (cost + 5, edits + "I", [*out, name + ":"]))
        return best

    for (_, role, text), fault in zip(rows, faults, strict=True):
        new = {}
        for q, (cost, edits, out) in insert(best).items():
            options = [(q, (cost + 2, edits + "D", out))]
            if fault in "KT":
                extra = 5 * (fault == "T")
                options.append((follow(q, role[:1]), (cost + extra, edits + "K", [*out, f"{role}:{text}"])))
                options += [(follow(q, name[0]), (cost + extra + 1, edits + "R", [*out, f"{name}:{text}"])) for name in ("user", "assistant")]
            for to, value in options:
                if to is not None:
                    new[to] = min(new.get(to, (10**9,)), value)
        best = new
    cost, edits, out = min(v for q, v in insert(best).items() if q in ("", "a"))
    turns = [t for t, _, _ in rows if t is not None]
    initials = [role[:1] for _, role, _ in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(x) for x in "BDT"),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)), cost, edits, hashlib.sha256("\n".join(out).encode()).hexdigest(),
    )


def ordered(rows):
    key = lambda role, text: hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
    clean = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(clean, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), key(x[1], x[2])))


def check(spark, conversations, chunk_rows=dialogue.CHUNK_ROWS):
    frame = spark.createDataFrame([(c, *row) for c, rows in conversations.items() for row in rows], TURNS)
    pieces = dialogue.repair(frame, chunk_rows)
    got = {r.conv_id: tuple(r)[1:] for r in dialogue.digests(pieces).collect()}
    assert got == {c: plain(ordered(rows)) for c, rows in conversations.items()}
    return pieces


def some(rnd, n):
    texts = ["ok.", "so?", "cut", "", " ", "yes!\n", "no. ", "open end"] + [f"t{i}." for i in range(12)]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    return [(rnd.choice([None, i, i, i + 1, i + 3]), rnd.choice(roles), rnd.choice([*texts, None])) for i in range(n)]


@pytest.mark.parametrize("chunk_rows", [dialogue.CHUNK_ROWS, 3])
def test_repair_equals_plain_search(spark, chunk_rows):
    rnd = random.Random(chunk_rows)
    conversations = {i: some(rnd, rnd.choice([1, 2, 3, 5, 8, 40])) for i in range(60)} | {None: some(rnd, 9)}
    check(spark, conversations, chunk_rows)


def test_one_long_conversation_over_many_chunks_and_ranges(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.choice(["user", "assistant"]), f"turn {i}" + rnd.choice([".", ".", ""])) for i in range(3000)]
    rows += [(i, "user", "the same.") for i in range(1000, 2000)]  # hundreds of chunks of nothing but deletions
    conversations = {1: rows, 2: [(0, "user", "hi."), (1, "assistant", "hello.")], 3: [(i, "system", "s.") for i in range(500)]}
    check(spark, conversations, 16)


def test_fix_up_passes_end_once_vectors_differ_by_constants(spark):
    rnd = random.Random(8)
    rows = [(i, rnd.choice(["user", "assistant"]), f"{i}.") for i in range(2000)]
    frame = spark.createDataFrame([(1, *r) for r in rows], TURNS)
    passes = []
    dialogue.stitched(dialogue.chunks(frame, 50).where("not whole"), passes).collect()
    assert passes[-1] == 0 and len(passes) <= 4 and sum(passes) < 2 * 40


def test_vectors_that_differ_by_a_constant_stay_so():
    rnd = random.Random(2)
    for _ in range(200):
        codes = bytes(rnd.choice([0, 1, 2, 3, 5, 6, 8]) for _ in range(rnd.randrange(1, 30)))
        runs = [rnd.randrange(1, 4) if c == dialogue.RUN else 1 for c in codes]
        right = tuple(rnd.randrange(12) for _ in range(4))
        a, b = dialogue.vectors(codes, runs, right)[0], dialogue.vectors(codes, runs, tuple(x + 7 for x in right))[0]
        assert [x + 7 for x in a] == list(b)


def test_repaired_turns_follow_the_pattern(spark):
    rnd = random.Random(11)
    pieces = check(spark, {i: some(rnd, 12) for i in range(20)}, 4)
    by = {}
    for r in sorted(dialogue.repaired_turns(pieces).collect(), key=lambda r: (r.conv_id, r.part, r.seq, r.nth)):
        by.setdefault(r.conv_id, []).append(r.role[:1])
    assert by and all(re.fullmatch("(s?(ua)+)?", "".join(x)) for x in by.values())


def test_damage_and_conversations_without_rows(spark, scratch):
    rows = [(c, t, ["user", "assistant"][t % 2], f"text {c} {t}.") for c in range(40) for t in range(3)] + [(None, None, None, None), (100, 1, "user", "x" * 300_000 + ".")]
    spark.createDataFrame([(*r, 1, "z") for r in rows], f"{TURNS}, part int, codes string").write.parquet(f"{scratch}/conversations.parquet")
    got = {r.conv_id: tuple(r)[1:] for r in dialogue.query(spark, scratch).collect()}
    kept = {r[0]: [] for r in rows}
    for c, t, role, text in rows:
        shown = [" " if x is None else str(x) for x in (c, t, role, text)]
        how = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        role, text = "user" if how == 4 else shown[2], "" if how == 1 else re.sub("[.!?]", "", shown[3]) if how == 2 else shown[3]
        kept[c] += [(t, role, text)] * (how != 0) * (2 if how == 3 else 1)
    assert got == {c: plain(ordered(x)) for c, x in kept.items()}
    assert any(not x for x in kept.values()) or len(kept) == 42


def test_empty_table(spark):
    assert dialogue.digests(dialogue.repair(spark.createDataFrame([], TURNS))).count() == 0
