"""Host verdicts against a brute-force version, and hosts that only one of the rules condemns."""

import statistics

from riskengine.llm.host_rules import quality_rules

WORDS = [f"w{i}" for i in range(60)]
CLEAN = " ".join(WORDS)
SYMBOLS = " ".join(w + ("$" if i % 5 == 0 else "") for i, w in enumerate(WORDS))  # 12 of 60 words
AT_LIMIT = " ".join(w + ("$" if i % 10 == 0 else "") for i, w in enumerate(WORDS))  # 6 of 60: not over 10 %
LINES = "\n".join([" ".join(WORDS[:30])] + [f"l{i % 4}" for i in range(8)])  # 4 of 9 lines repeat
SHORT = "too short"


def brute(rows):
    """(host, rate, failed) by plain arithmetic over (id, text, host) rows whose texts repeat no eight words."""
    def failed(text):
        words, lines = (text or "").split(), [x for x in (text or "").split("\n") if x.strip()]
        symbols = sum(c in "#*$%&|<>" for c in text or "")
        return len(words) < 20 or 100 * symbols > 10 * len(words) or 100 * (len(lines) - len(set(lines))) > 30 * len(lines)

    hosts = {}
    for _, text, host in rows:
        hosts.setdefault(host, []).append(failed(text))
    own = [sum(f) / len(f) for f in hosts.values()]
    m, v = statistics.fmean(own), statistics.pvariance(own)
    s = min(1e6, max(1.0, m * (1 - m) / v - 1)) if v else 1e6
    return {h: round((sum(f) + m * s) / (len(f) + s), 6) for h, f in hosts.items()}


def judged(spark, rows):
    return quality_rules(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()


def test_rates_and_verdicts_equal_brute_force(spark):
    kinds = {"clean": [CLEAN] * 9 + [SHORT], "symbols": [SYMBOLS] * 9 + [CLEAN], "lines": [LINES] * 9 + [CLEAN],
             "limit": [AT_LIMIT] * 10, None: [None] + [CLEAN] * 5}
    rows, i = [], 0
    for host, texts in kinds.items():
        for text in texts:
            rows.append((i, text, host))
            i += 1
    rates, host_of = brute(rows), {r[0]: r[2] for r in rows}
    found = judged(spark, rows)
    assert len(found) == len(rows)
    for r in found:
        rate = rates[host_of[r.doc_id]]
        assert r.host_rate == rate
        assert r.kept == (not r.base_failed and rate <= 0.5)
    # Their own base verdict holds nothing against these texts; their hosts do.
    gone = {host_of[r.doc_id] for r in found if not r.base_failed and not r.kept}
    assert gone == {"symbols", "lines"}
    assert not any(r.base_failed for r in found if host_of[r.doc_id] in gone)


def test_a_small_host_is_not_judged_on_one_text(spark):
    rows = [(i, CLEAN, f"h{i % 10}") for i in range(400)] + [(1000, SYMBOLS, "new"), (1001, CLEAN, "new")]
    assert all(r.kept for r in judged(spark, rows))
