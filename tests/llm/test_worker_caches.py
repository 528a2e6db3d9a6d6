import public_tokenizers

from knotwork.llm import common
from knotwork.llm.word_ids import LeadingSpace, word_ids


def test_frequent_words_outlive_a_full_cache():
    words = LeadingSpace(public_tokenizers.path("byte_bpe_50k.json"), 10)
    computed = []
    compute = words.compute
    words.compute = lambda word: computed.append(word) or compute(word)
    texts = [f"a common w{i} common x{i}" for i in range(60)]
    assert all(words.ids(t) == words.encode(t) for t in texts)
    assert computed.count("common") == 1 and len(words) + len(words.former) <= 20


def test_a_worker_frees_the_caches_of_another_operator():
    path = public_tokenizers.path("byte_bpe_50k.json")
    common.start_work("packing")
    kept = word_ids(path, LeadingSpace)
    common.start_work("packing")
    assert word_ids(path, LeadingSpace) is kept
    common.start_work("secret_tags")
    assert word_ids.cache_info().currsize == 0


def test_words_around_a_line_end_equal_the_library():
    words = LeadingSpace(public_tokenizers.path("byte_bpe_50k.json"), 1000)
    texts = ["one two.\nThree four", "a\nB", "x été!?\nÜber, und", "s's.\nIt's", "end.\n\nNew", "end.\n New", "end. \nNew", "a.\n9b", "a\n.b", "tab.\n\tx"]
    assert all(words.ids(t) == words.encode(t) for t in texts)
