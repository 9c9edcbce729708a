"""The pipeline over a small table, stage by stage against brute force; and the package without it."""

from __future__ import annotations

import subprocess
import sys
import textwrap
from pathlib import Path

import corpus_pipeline
from lapstack.llm import pii, queries, simhash, toxicity
from lapstack.llm.common import table
from lapstack.session import stage

from .test_decontamination import by_hand
from .test_simhash import components

SF_DIR = "/root/testdata/sf0.001"
REPO = Path(__file__).resolve().parents[2]


def test_stages_against_brute_force(spark):
    docs = table(spark, SF_DIR, "documents")
    columns = docs.columns
    by_stage = [docs]
    for name, function in corpus_pipeline.STAGES:
        by_stage.append(stage(function(spark, by_stage[-1], SF_DIR), name))
    assert all(d.columns == columns for d in by_stage[:-1])
    rows = [{r.doc_id: r for r in d.collect()} for d in by_stage]

    scores = toxicity.with_scores(docs, table(spark, SF_DIR, "labels"))
    assert set(rows[1]) == {r.doc_id for r in scores.collect() if r.predicted == 0}
    ids = sorted(rows[1])
    low = components(ids, [simhash.fingerprint(rows[1][i].text or "") for i in ids])
    assert set(rows[2]) == {i for i in ids if low[i] == i}
    items = [(r.item_id, r.text) for r in table(spark, SF_DIR, "benchmark").collect()]
    hit = {i for i, *_ in by_hand([(i, r.text) for i, r in rows[2].items()], items)}
    assert set(rows[3]) == set(rows[2]) - hit
    assert {i: r.text for i, r in rows[4].items()} == {i: pii.pseudonyms(r.text, queries.PII_KEY)[0] for i, r in rows[3].items()}
    assert set(rows[5]) == set(rows[4])
    assert {r.doc_id: r.token_ids for r in corpus_pipeline.run(spark, SF_DIR).collect()} == {i: r.token_ids for i, r in rows[5].items()}


def test_entry_without_the_subpackage():
    code = textwrap.dedent(
        """
        import sys
        class Gone:
            def find_spec(self, name, path=None, target=None):
                if name.startswith("lapstack.llm") or name == "corpus_pipeline":
                    raise ImportError(name)
        sys.meta_path.insert(0, Gone())
        import __spark_entry__ as e
        names = e.queries()
        assert "pipeline" not in names and not any(n.startswith("op") for n in names) and len(names) > 100
        assert set(e.oracle_sql()) <= set(names)
        """
    )
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True, timeout=120)
