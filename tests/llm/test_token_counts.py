import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from attesta.llm import token_counts as tc

PATH = public_tokenizers.path("piece_bpe_32k.model")


def greedy(pieces, longest, word):
    total, i = 0, 0
    while i < len(word):
        for n in range(min(longest, len(word) - i), 0, -1):
            if word[i : i + n] in pieces:
                total, i = total + 1, i + n
                break
        else:
            total, i = total + len(word[i].encode("utf-8", "replace")), i + 1
    return total


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("abcé", min_size=1, max_size=6), min_size=1, max_size=14), st.text("abcéz", max_size=30))
def test_automaton_is_greedy_longest_match(pieces, word):
    assert tc.Automaton(pieces).count(word) == greedy(pieces, 6, word)


def test_documents_against_greedy_search(spark, table):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))]
    pieces = {model.id_to_piece(i) for i in plain}
    longest = max(map(len, pieces))
    docs = table("documents").filter("doc_id < 40 and length(text) < 4000")
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in tc.count_tokens(docs, PATH).collect():
        words = tc._WORD.findall(text[r.doc_id].lower())
        assert r.n_words == len(words) and r.n_tokens == sum(greedy(pieces, longest, "▁" + w) for w in words)


def test_a_word_of_a_million_characters_is_linear():
    assert tc.automaton(PATH).count("▁" + "ab" * 500_000) > 0


def test_awkward_rows(awkward):
    got = tc.count_tokens(awkward, PATH).collect()
    assert len(got) == awkward.count()
    assert all((r.n_words, r.n_tokens) == (0, 0) for r in got if r.doc_id in (1, 2, 3))
    assert len({(r.n_words, r.n_tokens) for r in got if r.doc_id in (4, None)}) == 1
    assert tc.count_tokens(awkward.limit(0), PATH).count() == 0
