"""Spelling variants of the corpus's words by an index of variable-length grams.

Words are counted in the tasks that read the texts and added up by Spark. A word stands
between two marks and gives one gram at each place: the shortest one of at least `LEAST`
characters that the dictionary does not hold as frequent, so grams grow where short ones
are common. The dictionary holds the grams that more than a threshold of places begin
with, and the threshold grows with the vocabulary, so that at most
(GREATEST - LEAST) * `DICTIONARY` grams are sent to the tasks.

A gram is read from its own characters alone. One edit therefore leaves all grams that do
not span it as they are, at the same distance from the word's start or from its end. How
many grams an edit can touch at most is counted for every word (its affected-gram bound);
with one more than that many of its grams, taken from the shortest lists first, each near
pair has a gram in common that lies in both selections. Only those lists are merged, by
gram, distance and length, and every pair found is verified in the join itself, which
emits near pairs only. A gram has at most `min_chars` characters, so no word is too short.

Defined results: null texts have no words, a null id counts as an empty one; repeated rows
count each time. Of several near words with the same n the smallest in code-point order
is the form. Without words of enough occurrences the result is empty. Only the id and the
text are read; other columns do not matter.
"""

import math
import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from paperloom.llm.runtime import ship, written

LEAST, GREATEST, DICTIONARY = 2, 5, 20_000
RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}
_PIECE, _HELD = 1 << 20, 200_000


def pieces(text, size=_PIECE):
    """The text in pieces of about `size` characters; no run is cut."""
    start = 0
    while start < len(text):
        stop = min(start + size, len(text))
        rest = RUN.match(text, stop)
        stop = rest.end() if rest else stop
        yield text[start:stop]
        start = stop


def dropped(word, crc):
    """The word less one character where 97 divides its checksum."""
    if crc % 97:
        return word
    at = crc % len(word)
    return word[:at] + word[at + 1 :]


def _count(min_chars):
    def run(batches):
        held = Counter()

        def flush():
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
            )
            held.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for piece in pieces(text):
                    for run_, n in Counter(RUN.findall(piece)).items():
                        if len(run_) < min_chars:
                            continue
                        word = run_.lower() if run_.isascii() else run_.translate(_LOWER)
                        word = dropped(word, zlib.crc32(word.encode(), start))
                        if len(word) >= min_chars:
                            held[word] += n
                    if len(held) > _HELD:
                        yield flush()
        yield flush()

    return run


def counted_words(docs, min_chars, min_count, id_column="doc_id", text_column="text"):
    """(word, n) of the words with enough characters and occurrences."""
    source = docs.select(F.col(id_column).cast("string").alias("id"), F.col(text_column).cast("string").alias("text"))
    counts = source.mapInArrow(_count(min_chars), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= min_count)


def marked(word):
    return f"^{word}$"


def grams(word, frequent, longest):
    """(gram, place) at every place of the marked word."""
    text = marked(word)
    found = []
    for place in range(len(text) - LEAST + 1):
        stop = place + LEAST
        while stop < len(text) and stop - place < longest and text[place:stop] in frequent:
            stop += 1
        found.append((text[place:stop], place))
    return found


def most_affected(found, size):
    """The most grams that one edit of the marked text of `size` characters can touch."""
    change = [0] * (size + 1)
    for gram, place in found:
        change[place] += 1
        change[place + len(gram)] -= 1
    most = now = 0
    for step in change:
        now += step
        most = max(most, now)
    return most


def _prefixes(longest):
    def run(batches):
        held = Counter()
        for batch in batches:
            for word in batch.column(0).to_pylist():
                text = marked(word)
                for size in range(LEAST, longest):
                    held.update(text[k : k + size] for k in range(len(text) - size + 1))
                if len(held) > _HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array(list(held.values()))], names=["gram", "n"])
                    held.clear()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array(list(held.values()))], names=["gram", "n"])

    return run


def gram_dictionary(words, longest, dictionary=DICTIONARY):
    """The frequent grams, at most (longest - LEAST) * dictionary of them."""
    places = words.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    threshold = max(4, math.ceil(places / dictionary))
    counts = words.select("word").mapInArrow(_prefixes(longest), "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return frozenset(row["gram"] for row in counts.where(F.col("n") > threshold).select("gram").collect())


def _decompose(frequent, longest):
    def run(batches):
        for batch in batches:
            kept, places, touched = [], [], []
            for word in batch.column(0).to_pylist():
                found = grams(word, frequent.value, longest)
                kept.append([gram for gram, _ in found])
                places.append([place for _, place in found])
                touched.append(most_affected(found, len(word) + 2))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(kept, pa.list_(pa.string())),
                    pa.array(places, pa.list_(pa.int32())),
                    pa.array(touched, pa.int32()),
                ],
                names=["word", "n", "grams", "places", "bound"],
            )

    return run


def near_pairs(words, min_chars, dictionary=DICTIONARY):
    """(a, n_a, b, n_b) of the words one edit apart, each pair once; `words` is a stored table."""
    spark = words.sparkSession
    longest = max(LEAST, min(GREATEST, min_chars))
    frequent = spark.sparkContext.broadcast(gram_dictionary(words, longest, dictionary))
    split = written(
        words.mapInArrow(
            _decompose(frequent, longest), "word string, n long, grams array<string>, places array<int>, bound int"
        )
    )
    lists = split.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count("*").alias("size"))
    each = split.select("word", "n", "bound", F.explode(F.arrays_zip("grams", "places")).alias("e"))
    sized = each.select("word", "n", "bound", F.col("e.grams").alias("gram"), F.col("e.places").alias("place"))
    chosen = (
        sized.join(lists, "gram")
        .groupBy("word", "n", "bound")
        .agg(F.array_sort(F.collect_list(F.struct("size", "gram", "place"))).alias("by_size"))
        .select("word", "n", F.explode(F.expr("slice(by_size, 1, bound + 1)")).alias("e"))
        .select("word", "n", F.length("word").alias("chars"), "e.gram", "e.place")
    )
    chosen = written(chosen)
    from_end = F.col("chars") - F.col("place")

    def entries(side, distance, chars, longer):
        return F.struct(
            F.lit(side).alias("side"), distance.alias("distance"), chars.alias("length"), F.lit(longer).alias("longer")
        )

    place, chars = F.col("place"), F.col("chars")
    listed = F.array(entries("start", place, chars, False), entries("end", from_end, chars, False))
    asked = F.array(
        entries("start", place, chars, False),
        entries("start", place, chars + 1, True),
        entries("end", from_end, chars + 1, True),
    )
    index = chosen.select("gram", F.explode(listed).alias("e"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    index = index.select("gram", "e.side", "e.distance", "e.length", "b", "n_b")
    probes = chosen.select("gram", F.explode(asked).alias("e"), F.col("word").alias("a"), F.col("n").alias("n_a"))
    probes = probes.select("gram", "e.side", "e.distance", "e.length", "e.longer", "a", "n_a")
    key = ["gram", "side", "distance", "length"]
    same = [probes[k] == index[k] for k in key]
    near = (F.col("longer") | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1)
    condition = same[0] & same[1] & same[2] & same[3] & near
    return probes.join(index, condition).select("a", "n_a", "b", "n_b").distinct()


def followed(forms):
    """(word, root): each word's last form, by doubling the steps until none moves."""
    now = written(forms.select("word", F.coalesce("form", "word").alias("root"), F.col("form").isNotNull().alias("moved")))
    while now.where("moved").limit(1).count():
        onward = now.where("word <> root").select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = now.join(onward, "root", "left")
        now = written(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
    return now.select("word", "root")


def spelling_variants(docs, min_chars=5, min_count=3, ratio=2, dictionary=DICTIONARY, id_column="doc_id", text_column="text"):
    """(word, form, root, n, n_near, form_n) of every word that occurs often enough."""
    ship(docs.sparkSession)
    words = written(counted_words(docs, min_chars, min_count, id_column, text_column))
    pairs = written(near_pairs(words, min_chars, dictionary))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).union(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n"))
    )
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best")
    )
    joined = words.join(best, "word", "left")
    good = -F.col("best.order") >= ratio * F.col("n")
    forms = written(
        joined.select(
            "word",
            F.when(good, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(good, -F.col("best.order")).alias("form_n"),
        )
    )
    return forms.join(followed(forms), "word").select("word", "form", "root", "n", "n_near", "form_n")
