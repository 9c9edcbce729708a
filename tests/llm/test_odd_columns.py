"""Columns of a caller that are named like those an operator might use inside stay what they are."""

from __future__ import annotations

import public_tokenizers
import pytest

from lapstack.llm import (
    decontamination,
    fingerprints,
    language_id,
    pii,
    queries,
    sentencepieces,
    simhash,
    token_counts,
    toxicity,
)

NAMES = (
    "_rows rows times _fp fp print _root root class _counted counted _hashes hash key range to end own next _done done _found"
    " found_ _made made winners host salt item items words hits required size part bucket group label _order learner bytes"
    " component_id named _n n sketch_ Times KEY"
).split()
SCHEMA = "doc_id bigint, text string, n_chars bigint"


def texts(names):
    rows = [(1, "one text of eight words for the trie"), (1, "another text entirely, with other words in it"), (2, None), (None, "a third text of words")]
    rows += [(3, "one text of eight words for the trie"), (4, "mail a.b@example.org or 10.20.30.40"), (4, "mail a.b@example.org or 10.20.30.40")]
    return [(i, t, None if t is None else len(t), *[f"{n} {k}" for n in names]) for k, (i, t) in enumerate(rows)]


OPERATORS = {
    "simhash": (lambda d, s: simhash.one_per_class(d), set()),
    "decontamination": (lambda d, s: decontamination.decontaminate(d, s.createDataFrame([(1, "none of these words here")], "item_id int, text string")), set()),
    "pii": (lambda d, s: pii.pseudonymise(d, b"a key of sixteen bytes"), {"found"}),
    "sentencepieces": (lambda d, s: sentencepieces.with_pieces(d, public_tokenizers.path(queries.PIECES), decoded=True), {"token_ids", "n_tokens", "decoded"}),
    "token_counts": (lambda d, s: token_counts.with_prefix_counts(d, public_tokenizers.path(queries.BYTE_BPE)), {"prefix_steps", "n_tokens"}),
    "fingerprints": (lambda d, s: fingerprints.with_fingerprint(d), {"sketch"}),
    "language_id": (lambda d, s: language_id.with_language(d, language_id.Model(("en",), language_id.Settings(), {})), {"lang_pred", "score"}),
    "toxicity": (lambda d, s: toxicity.with_scores(d, s.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, toxic int")), {"score", "predicted"}),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_other_columns_stay(spark, name):
    operator, new = OPERATORS[name]
    seen, names = set(), []
    for n in NAMES:
        if n.lower() not in seen:
            seen.add(n.lower())
            names.append(n)
    schema = SCHEMA + "".join(f", `{n}` string" for n in names)
    docs = spark.createDataFrame(texts(names), schema)
    out = operator(docs, spark)
    assert set(out.columns) == set(docs.columns) | new
    rows = out.collect()
    assert rows
    for r in rows:
        tags = {r[n].rsplit(" ", 1)[0] == n and r[n].rsplit(" ", 1)[1] for n in names}
        assert len(tags) == 1  # all columns of a row are those of one row
