"""Line alignment, benchmark leaks, archives and chats against brute force or an exact round trip."""

import base64
import hashlib
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelframe.llm import chat, decontaminate, linedup, warc
from parcelframe.llm.queries import QUERIES
from parcelframe.session import work_folder
from tests.llm.helpers import awkward, frame, prose


def lines_of(seed, n):
    rng = random.Random(seed)
    return [prose(seed * 1000 + k, rng.randint(6, 14)).replace("\n", " ") for k in range(n)]


# --- line alignment ---------------------------------------------------------------------------------------


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=14), st.lists(st.integers(0, 5), max_size=14), st.integers(1, 4))
def test_deleted_blocks_are_blocks_of_the_earlier_text(a, b, least):
    gone = linedup.common_blocks(a, b, [1] * len(b), least)
    runs, block = [], []
    for j in [*sorted(gone), None]:
        if block and j != block[-1] + 1:
            runs.append(block)
            block = []
        block.append(j)
    for run in runs:
        assert len(run) >= least
        # Each line of a run belongs to a stretch of ``least`` lines that the earlier text has as well.
        for j in run:
            stretches = [b[s : s + least] for s in range(max(run[0], j - least + 1), min(j, run[-1] - least + 1) + 1)]
            assert any(x == a[i : i + least] for x in stretches for i in range(len(a)))


def test_moved_and_repeated_blocks_are_found():
    assert linedup.common_blocks(list("abcdef"), list("defxabc"), [1] * 7, 3) == {0, 1, 2, 4, 5, 6}
    assert linedup.common_blocks(list("xabc"), list("abcyabc"), [1] * 7, 3) == {0, 1, 2, 4, 5, 6}


def test_passages_crossed_by_short_lines_are_found():
    assert linedup.common_blocks(["p", "h"], ["h", "p"], [2, 60], 25) == {1}
    crossed = linedup.common_blocks(list("abcuvwxyz"), list("uvwxyzabc"), [2] * 6 + [10] * 3, 25)
    assert crossed == {6, 7, 8}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=14), st.lists(st.tuples(st.integers(0, 5), st.integers(1, 3)), max_size=14), st.integers(1, 6))
def test_every_common_run_with_enough_words_is_deleted(a, pairs, least):
    b, words = [x for x, _ in pairs], [n for _, n in pairs]
    want = set()
    for i in range(len(a)):
        for j in range(len(b)):
            n = 0
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                n += 1
            if sum(words[j : j + n]) >= least:
                want.update(range(j, j + n))
    assert linedup.common_blocks(a, b, words, least) == want


def test_shared_passages_go_from_later_documents_and_nothing_else(spark):
    passage, short = lines_of(1, 8), lines_of(2, 1)
    docs = {k: lines_of(10 + k, 6) for k in range(40)}
    for k in range(3, 40, 3):
        docs[k][2:2] = passage
    for k in range(0, 40, 2):
        docs[k].insert(1, short[0])
    docs[41], docs[42] = docs[3][:], [*passage[4:], "", *passage[:4]]
    texts = {k: "\n".join(x) for k, x in docs.items()}
    rows = {r.doc_id: r for r in linedup.remove_shared(frame(spark, texts), lines_col="removed").collect()}
    for k, own in docs.items():
        left = rows[k].text.split("\n")
        if k == 3:
            assert rows[k].text == texts[k] and rows[k].removed is None
        elif k < 40:
            assert left == ([x for x in own if x not in passage] if k % 3 == 0 and k else own)
    assert rows[41].text == ""
    assert rows[42].text == ""


def test_no_line_is_lost(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    before = {x.strip() for r in docs.collect() for x in (r.text or "").split("\n")}
    found = QUERIES["op2_line_alignment"](spark, data).collect()
    assert before - {""} == {x.strip() for r in found for x in r.text.split("\n")} - {""}
    anchors = defaultdict(set)
    for r in found:
        hashes, words, _ = linedup.line_table(r.text)
        for a in linedup.anchors(hashes, words, 25):
            anchors[a].add(r.doc_id)
    source = defaultdict(set)
    for r in docs.collect():
        hashes, words, _ = linedup.line_table(r.text)
        for a in linedup.anchors(hashes, words, 25):
            source[a].add(r.doc_id)
    assert any(len(ids) > 1 for ids in source.values())
    assert all(len(anchors[a]) <= 1 for a in source)


def test_awkward_documents_are_answered(spark):
    rows = linedup.remove_shared(frame(spark, awkward()))
    assert rows.columns == frame(spark, []).columns
    got = Counter((r.doc_id, r.text) for r in rows.collect())
    # 10 repeats a row without id, which takes no part; so nothing changes.
    assert got == Counter(awkward())
    assert linedup.remove_shared(frame(spark, [])).count() == 0


# --- benchmark leaks --------------------------------------------------------------------------------------

QUESTION = "If Tom buys 12 apples for 5 dollars and later sells 7 apples to Anna how much money does Tom have after 3 days of trade"
ITEMS = [(1, QUESTION), (2, prose(77, 40)), (3, None), (4, ""), (5, "too few words"), (None, prose(78, 40))]


def leaks(spark, texts):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    return decontaminate.find_leaks(frame(spark, texts), items)


def test_exact_and_changed_questions_are_found_and_clean_ones_not(spark):
    changed = QUESTION.replace("Tom", "Eve").replace("Anna", "Bob").replace("12", "40").replace("5 ", "9 ").replace("7 ", "8 ")
    clash = changed.replace("does Eve", "does Zoe").replace("8 apples", "8 pears")
    slots = "If Eve buys 40 apples for 9 dollars and later sells 8 apples to Bob how much money does Zoe have after 4 days of trade"
    texts = [
        (1, prose(1, 300) + " " + QUESTION + " " + prose(2, 300)), (2, "So. " + changed), (3, prose(3, 900)), (4, prose(77, 40)),
        (5, QUESTION[:50]), (6, clash), (7, slots), *[(20 + k, t) for k, (_, t) in enumerate(awkward())],
    ]
    got = {(r.doc_id, r.item_id): r for r in leaks(spark, texts).collect()}
    assert {k: got[k].kind for k in ((1, 1), (2, 1), (4, 2))} == {(1, 1): "exact", (2, 1): "changed", (4, 2): "exact"}
    assert not {3, 5, *range(20, 40)} & {d for d, _ in got}
    # Tom is Eve here and Zoe there: five of six values are replaced by one value each.
    assert got[7, 1].consistency == pytest.approx(6 / 7, abs=0.05) and got[2, 1].consistency == 1


def test_names_and_numbers_of_several_words_are_one_slot(spark):
    longer = QUESTION.replace("Tom", "Mary Ann").replace("Anna", "Jo Lee").replace("12", "1 200")
    listed = QUESTION.replace("to Anna", "to Jo, Lee, Kim, Ann, Bo, Cy")
    got = {r.doc_id: r for r in leaks(spark, [(1, longer), (2, prose(4, 50) + ". " + longer)]).collect()}
    assert {k: (r.kind, r.share, r.consistency) for k, r in got.items()} == {1: ("changed", 1, 1), 2: ("changed", 1, 1)}
    assert len(decontaminate.template(*decontaminate.Words()([listed]))[2]) == len(QUESTION.split()) + 5


def test_items_without_plain_words_and_copies_in_other_capitals_are_found(spark):
    title = "The Old Man And The Sea By Ernest Hemingway Of Oak Park"
    solid = "東京から大阪まで電車で何時間かかりますか"
    texts = {1: QUESTION, 2: title.upper(), 3: "1 22 333 4444 55555 666666 7777777", 4: "Quo vadis", 5: solid}
    items = spark.createDataFrame(list(texts.items()), "item_id long, text string")
    docs = [(k, prose(k, 60) + " " + t + " " + prose(k + 50, 60)) for k, t in texts.items()]
    docs += [(10 + k, prose(k, 60) + ". " + t.swapcase() + ". " + prose(k + 50, 60)) for k, t in texts.items()] + [(20, f"これは{solid}という文です"), (21, prose(9, 200))]
    got = {(r.doc_id, r.item_id, r.kind, r.share) for r in decontaminate.find_leaks(frame(spark, docs), items).collect()}
    assert got == {(d, k, "exact", 1) for k in texts for d in (k, 10 + k)} | {(20, 5, "exact", 1)}


def test_names_have_a_partner_each_and_numbers_may_be_words(spark):
    one = QUESTION.replace("Tom", "Eve").replace("Anna", "Eve")
    worded = QUESTION.replace("12", "twenty five").replace("5 ", "five ").replace("7 ", "eight ").replace("3 ", "three ").replace("Tom", "Eve")
    got = {r.doc_id: r for r in leaks(spark, [(1, one), (2, worded), (3, prose(1, 99) + ". " + worded)]).collect()}
    assert {k: (r.item_id, r.kind, r.share, r.consistency) for k, r in got.items()} == {2: (1, "changed", 1, 1), 3: (1, "changed", 1, 1)}


def test_one_passage_in_many_items_and_documents(spark):
    shared = prose(31, 30)
    items = spark.createDataFrame([(k, shared + f" item {k} " + prose(40 + k, 60)) for k in range(12)] + [(50, shared)], "item_id long, text string")
    docs = frame(spark, [(k, prose(300 + k, 40) + " " + shared) for k in range(40)])
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, items).collect()} == {(k, 50) for k in range(40)}


def test_rows_without_an_id_stay_and_text_ids_are_refused(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontaminate.without_leaks(frame(spark, [(None, QUESTION), (4, QUESTION), (4, QUESTION)]), items).collect()
    assert [(r.doc_id, r.text, r.leak, r.gone) for r in kept] == [(None, QUESTION, 7, 6)]
    for fn in (lambda d: decontaminate.find_leaks(d, items), linedup.remove_shared):
        with pytest.raises(TypeError, match="whole numbers"):
            fn(frame(spark, []).selectExpr("string(doc_id) as doc_id", "text"))


def test_one_window_of_a_long_item_is_no_leak(spark):
    item = "Alice Bob, Carol Dave, Erin Frank, Grace Heidi, Ivan Judy, Kim Leo, Mia Ned went to the market"
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert decontaminate.find_leaks(frame(spark, [(1, "Then Zoe went to the market")]), items).count() == 0


def test_inconsistent_replacement_is_no_leak(spark):
    item = "The sum of 5 and 5 and 6 and 6 is then taken from the value of 5 plus 6 in the end of it"
    mixed = "The sum of 1 and 2 and 3 and 4 is then taken from the value of 8 plus 9 in the end of it"
    even = "The sum of 1 and 1 and 3 and 3 is then taken from the value of 1 plus 3 in the end of it"
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = decontaminate.find_leaks(frame(spark, [(1, mixed), (2, even)]), items).collect()
    assert [(r.doc_id, r.kind) for r in got] == [(2, "changed")]
    both = decontaminate.find_leaks(frame(spark, [(3, mixed + ". " + even), (4, even + " x. " + item)]), items).collect()
    assert {(r.doc_id, r.kind) for r in both} == {(3, "changed"), (4, "exact")}


def test_leaks_of_the_given_tables_hold_every_exact_passage(spark):
    data = "/root/testdata/sf0.01"
    got = {(r.doc_id, r.item_id) for r in QUERIES["op1_template_leaks"](spark, data).collect()}
    docs = spark.read.parquet(f"{data}/documents.parquet").collect()
    items = spark.read.parquet(f"{data}/benchmark.parquet").collect()
    exact = {(d.doc_id, i.item_id) for d in docs for i in items if d.text and i.text in d.text}
    assert exact and exact <= got

    def windows(text):
        return set(decontaminate.template(*decontaminate.Words()([text]))[1].tolist()) - {0}

    own = {i.item_id: windows(i.text) for i in items}
    for d in docs:
        seen = windows(d.text or "")
        for k, mine in own.items():
            assert ((d.doc_id, k) in got) <= (len(mine & seen) >= 0.8 * len(mine))


def test_empty_tables_and_kept_rows(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_leaks(frame(spark, awkward()), none).count() == 0
    assert leaks(spark, []).count() == 0
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontaminate.without_leaks(frame(spark, [(1, QUESTION), *awkward()[1:]]), items)
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(awkward()[1:])


# --- archives ---------------------------------------------------------------------------------------------

PAGES = [
    (1, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (9, "http://a/9 x\r\nInjected: 1", "<p>same</p>"), (3, None, None),
    (4, "", ""), (5, "http://a/5", "é" * 70_000 + "\r\n\r\nWARC/1.1\r\n"), (6, "http://a/6", "x\r\n"), (6, "http://a/6", "x\r\n"), (6, "u", "other"),
    (None, "http://n", "<p>same</p>"), (None, "http://n", "alone"), (8, "u", "x\r\n"),
]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "d") for r in rows], "page_id long, url string, html string, digest string")


@pytest.mark.parametrize(("least", "chunk"), [(0, 256 << 10), (0, 1000), (4, 7_001)])
def test_pages_come_back_from_archives(spark, least, chunk):
    table = warc.archive_pages(pages(spark, PAGES), least=least, chunk=chunk)
    rows = table.collect()
    assert max(len(r.data) for r in rows) <= chunk
    own = {}
    for k, _, html in PAGES:
        if k is not None and len((html or "").encode()) >= least:
            own[html or ""] = max(k, own.get(html or "", k))
    want = Counter()
    for k, _, html in PAGES:
        body = (html or "").encode()
        owner = own.get(html or "")
        owner = None if owner == k else owner
        want[k, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if owner is not None else "response", owner] += 1
    assert Counter(map(tuple, warc.archived_records(table).collect())) == want
    payloads = defaultdict(bytes)
    for r in sorted((r for r in rows if r.page_id == 5), key=lambda r: r.number):
        assert r.offset == len(payloads[5])
        payloads[5] += r.data
        assert r.digest == base64.b32encode(hashlib.sha1(payloads[5]).digest()).decode()
    assert payloads[5] == PAGES[5][2].encode()


def test_archives_roll_over_and_empty_tables_have_none(spark):
    folder = work_folder(spark, "warc-test")
    listed = warc.write_archives(warc.chunked(pages(spark, PAGES).coalesce(1)), folder, largest=500)
    assert listed.count() > 1 and warc.read_archives(listed).select("record_id").count() == len(PAGES)
    assert warc.archived_records(warc.archive_pages(pages(spark, []))).count() == 0


# --- chats ------------------------------------------------------------------------------------------------

MARKS = ["</s>", "<s>", "[INST]", "[/INST]", "\\", "\\\\", "text", " ", "\n", "é", "<", "/s>", "["]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(MARKS), max_size=12), st.lists(st.sampled_from(MARKS), max_size=4))
def test_any_turn_is_read_back(parts, role):
    made, _ = chat.render("".join(role), "".join(parts))
    assert list(chat.PARSER.turns(made * 2)) == [("".join(role), "".join(parts))] * 2


@pytest.mark.parametrize("broken", ["<s>", "x", "<s>[INST]a[/INST]b", "<s>a[INST]r[/INST]t</s>", "<s>[INST]a[INST]", "<s>\\</s>", "<s>[INST]r[/INST]t</s>y"])
def test_broken_transcripts_are_refused(broken):
    with pytest.raises(chat.ParseError):
        list(chat.PARSER.turns(broken))


def test_conversations_are_read_back(spark):
    rows = [
        (1, 1, "assistant", "yes </s>"), (1, 0, "user", None), (1, 1, "assistant", "yes </s>"), (2, 0, None, "[INST]"), (None, 5, "user", "x"),
        (None, None, "assistant", "y"), (3, 0, "assistant", ""), (4, 0, "</s>", "\\"), *[(9, k, "assistant" if k % 2 else "user", f"t{k}\\") for k in range(3000)],
    ]
    random.Random(1).shuffle(rows)
    turns = spark.createDataFrame([(*r, "z", 1) for r in rows], "conv_id long, turn long, role string, text string, formatted string, level int")
    formatted = chat.format_turns(turns)
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    assert set(got) == set(by)
    for conv, own in by.items():
        own = [x[2:] for x in sorted(own)]
        loss = "".join(t for r, t in own if r == "assistant")
        assert got[conv].n_turns == len(own)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for r in formatted.collect():
        assert r.role != "assistant" or chat._TOKENS.sub(lambda m: m[1], r.formatted[r.loss_from : r.loss_to]) == r.text
    empty = turns.limit(0)
    assert chat.read_back(chat.format_turns(empty)).count() == 0


def test_query_adds_the_conversation_of_marks(spark, data):
    got = {r.conv_id: r for r in QUERIES["op5_chat_round_trip"](spark, data).collect()}
    says = "</s>[INST] ok [/INST]"
    assert got[-7].n_turns == 2 and got[-7].loss_chars == len(says)
    assert got[-7].turns_sha256 == hashlib.sha256(f"user\n{says}\nassistant\n{says}\n".encode()).hexdigest()
