"""Pileup, alignment, pair merging and text sources against brute force."""

import gzip
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldmark.operators import align, near
from foldmark.operators.align import _glocal, align_pairs, align_reads, scan_library, seed_candidates, worst_penalty
from foldmark.operators.index import build_index
from foldmark.operators.pairs import merge_pairs
from foldmark.operators.pileup import pileup
from foldmark.plans.reads_to_counts import reads_to_counts
from foldmark.sources import counts as C
from foldmark.sources import fasta, fastq, tables

COMP = str.maketrans("ACGT", "TGCA")


def rc(s):
    return s.translate(COMP)[::-1]


def rand_seq(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def test_pileup_by_hand(spark):
    lib = spark.createDataFrame([(1, "d1", "GGAAAACCGU"), (2, "d2", "ACGU")], "design_idx bigint, name string, sequence string")
    aln = spark.createDataFrame([
        ("r1", "t", "d1", 1, "10M", "GGAAAACCGT"),      # no mutation
        ("r2", "t", "d1", 1, "2M1D7M", "GGAAACCGT"),    # deletion inside AAAA: moves to position 6
        ("r3", "t", "d1", 1, "10M", "GGACCACCGT"),      # adjacent mismatches at 4, 5: only 5 counts
        ("r4", "t", "d1", 3, "2M1I2M", "AATAA"),        # insertion after position 4
        ("r5", "t", "d2", 2, "3M", "CNT"),              # ambiguous base is no mutation
        ("r6", "t", "d1", 7, "2S3M", "TTCCG"),          # soft clip
    ], "read_id string, tag string, ref string, pos int, cigar string, seq string")
    got = {(r.design_idx, r.pos, r.measure): r.n for r in pileup(aln, lib).collect()}
    muts = {k: v for k, v in got.items() if k[2] != "coverage"}
    assert muts == {(1, 6, "del"): 1, (1, 5, "AC"): 1, (1, 4, "ins"): 1}
    cov = [got.get((1, p, "coverage"), 0) for p in range(1, 11)]
    assert cov == [3, 3, 4, 4, 4, 4, 4, 4, 4, 3]
    assert [got.get((2, p, "coverage"), 0) for p in range(1, 5)] == [0, 1, 1, 1]
    loose = {(r.design_idx, r.pos, r.measure): r.n for r in pileup(aln, lib, collapse=False).collect()}
    assert loose[(1, 4, "AC")] == 1 and loose[(1, 5, "AC")] == 1


def plain_pileup(alignments, refs, collapse, least):
    """Counts letter by letter, by the rules in pileup's docstring."""
    out = Counter()
    for ref_name, pos, cigar, seq, qual in alignments:
        design, ref = refs[ref_name]
        i, j, muts, blocks = 0, pos - 1, [], re.findall(r"(\d+)([MIDNSHP=X])", cigar)
        for b, (size, op) in enumerate(blocks):
            size = int(size)
            if op in "M=X":
                for x in range(size):
                    if seq[i + x] != ref[j + x]:
                        muts.append((j + x, j + x, ref[j + x] + seq[i + x]))
                    if ord(qual[i + x]) - 33 >= least:
                        out[design, j + x + 1, "coverage"] += 1
            if op == "D":
                room, shift = int(blocks[b + 1][0]) if b + 1 < len(blocks) else 0, 0
                while shift < room and ref[j + shift] == ref[j + shift + size]:
                    shift += 1
                muts.append((j + shift, j + shift + size - 1, "del"))
                for x in range(size):
                    out[design, j + x + 1, "coverage"] += 1
            if op == "I":
                out[design, j, "ins"] += 1
            i += size * (op in "MIS=X")
            j += size * (op in "MDN=X")
        begins = {m[0] for m in muts}
        for _, last, kind in muts:
            if "N" not in kind and not (collapse and last + 1 in begins):
                out[design, last + 1, kind] += 1
    return {k: n for k, n in out.items() if n}


def test_pileup_against_letter_by_letter(spark):
    rng = random.Random(21)
    refs = {f"d{i}": (i, "".join(rng.choice("ACGT") * rng.randint(1, 4) for _ in range(40))) for i in range(1, 6)}
    aln = []
    for _ in range(400):
        name = rng.choice(["d1", "d1", *refs])          # one design holds a large share
        ref = refs[name][1]
        pos, cigar, seq = rng.randint(1, 20), [], ""
        j = pos - 1
        for op in rng.choice(["M", "MDM", "MIM", "SMDMIM", "M=XM", "MDDM", "MNM", "HMIDM", "MDMDMS"]):
            size = rng.randint(1, 3) if op in "DIXNH" else rng.randint(1, 9)
            cigar.append(f"{size}{op}")
            if op in "M=X":
                seq += "".join(c if rng.random() < 0.8 else rng.choice("ACGTN") for c in ref[j:j + size])
            elif op in "IS":
                seq += rand_seq(rng, size)
            j += size * (op in "MDN=X")
        aln.append((name, pos, "".join(cigar), seq, "".join(rng.choice("#5I") for _ in seq)))
    lib = spark.createDataFrame([(i, n, s.replace("T", "U")) for n, (i, s) in refs.items()], "design_idx bigint, name string, sequence string")
    rows = [(f"r{k}", "t", *a) for k, a in enumerate(aln)]
    rows += [("x1", "t", "d1", None, "3M", "ACG", "III"), ("x2", "t", "d1", 1, None, "ACG", "III"), ("x3", "t", "d1", 1, "3M", None, None),
             ("x4", "t", "d1", 1, "", "", ""), ("x5", "t", "unknown", 1, "3M", "ACG", "III")]
    df = spark.createDataFrame(rows, "read_id string, tag string, ref string, pos int, cigar string, seq string, qual string")
    for collapse, least, letters in [(True, 0, 1 << 20), (False, 0, 0), (True, 20, 1 << 20)]:
        got = {(r.design_idx, r.pos, r.measure): r.n for r in pileup(df, lib, collapse, min_base_quality=least, broadcast_letters=letters).collect()}
        assert got == plain_pileup(aln, refs, collapse, least)
    plan = pileup(df, lib)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert pileup(df.limit(0), lib).count() == 0 and pileup(df, lib.limit(0)).count() == 0


def slow_score(read, ref):
    n, w, low = len(read), len(ref), -10**6
    h = [[0] * (w + 1)] + [[low] * (w + 1) for _ in range(n)]
    e = [[low] * (w + 1) for _ in range(n + 1)]
    f = [[low] * (w + 1) for _ in range(n + 1)]
    for i in range(1, n + 1):
        for j in range(w + 1):
            f[i][j] = max(h[i - 1][j] - 6, f[i - 1][j] - 1)
            if j:
                e[i][j] = max(max(h[i][j - 1], f[i][j - 1]) - 6, e[i][j - 1] - 1)
            sub = h[i - 1][j - 1] - (0 if read[i - 1] == ref[j - 1] else 3) if j else low
            h[i][j] = max(sub, e[i][j], f[i][j])
    return max(h[n])


def test_gapped_comparison_against_plain_recurrence():
    rng = random.Random(11)
    for _ in range(150):
        ref = rand_seq(rng, rng.randint(12, 30))
        read = list(ref[2:-2])
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(read))
            rng.choice([lambda: read.pop(i), lambda: read.insert(i, "G"), lambda: read.__setitem__(i, "T")])()
        read = "".join(read)
        score, start, cigar, edits = _glocal([read], [ref])[0]
        assert score == slow_score(read, ref)
        # the CIGAR reproduces the score
        import re
        i, j, total = 0, start, 0
        for n, op in re.findall(r"(\d+)([MID])", cigar):
            n = int(n)
            if op == "M":
                total -= 3 * sum(a != b for a, b in zip(read[i:i + n], ref[j:j + n]))
                i, j = i + n, j + n
            else:
                total -= 5 + n
                i, j = (i + n, j) if op == "I" else (i, j + n)
        assert total == score and i == len(read)


def plain_pairs(pairs, designs, max_insert):
    """(pair: best sum, designs that have it, first of them) by comparing every mate with every design and every window."""
    out = {}
    for name, a, b in pairs:
        found = {}
        for d, ref in designs.items():
            limit_a, limit_b = -worst_penalty(len(a)), -worst_penalty(len(b))
            places = []
            for read, limit in ((a, limit_a), (b, limit_b)):
                score, start, cigar, _ = _glocal([read], [ref])[0]
                places.append((score, start, start + sum(int(n) for n, op in re.findall(r"(\d+)([MD])", cigar))) if score >= limit else None)
            fits = []
            if all(places) and places[0][1] <= places[1][1] and max(places[0][2], places[1][2]) - places[0][1] <= max_insert:
                fits.append(places[0][0] + places[1][0])
            elif places[0] or places[1]:
                if places[0]:
                    x = _glocal([b], [ref[places[0][1]:places[0][1] + max_insert]])[0]
                    fits += [x[0] + places[0][0]] if x[0] >= limit_b else []
                if places[1]:
                    low = max(places[1][2] - max_insert, 0)
                    x = _glocal([a], [ref[low:places[1][1] + len(a) - limit_a - 5][:max_insert]])[0]
                    fits += [x[0] + places[1][0]] if x[0] >= limit_a and low + x[1] <= places[1][1] else []
            if fits:
                found[d] = max(fits)
        if found:
            best = max(found.values())
            tied = [d for d, v in found.items() if v == best]
            out[name] = (best, min(tied), len(tied) == 1)
    return out


def test_mates_are_placed_together(spark):
    rng = random.Random(31)
    flank, shared = rand_seq(rng, 40), rand_seq(rng, 60)
    designs = {d: rand_seq(rng, 50) + (shared if d % 2 else rand_seq(rng, 60)) + rand_seq(rng, 40) + flank for d in range(1, 9)}
    designs[9] = rand_seq(rng, 50) + rand_seq(rng, 1000) + flank
    def worn(s, n):
        s = list(s)
        for i in rng.sample(range(len(s)), n):
            s[i] = {"A": "C", "C": "G", "G": "T", "T": "A"}[s[i]]
        return "".join(s)
    pairs = [(f"s{d}", worn(designs[d][5:45], 1), flank) for d in range(1, 9)]              # the second mate fits every design
    pairs += [(f"b{d}", shared[5:50], worn(designs[d][112:148], 2)) for d in (1, 3, 5, 7)]  # the first fits four
    pairs += [(f"w{d}", designs[d][2:42], worn(designs[d][60:100], 7)) for d in (2, 4, 6)]  # the second has no seed
    pairs += [("tie", shared[:40], flank), ("far", designs[9][:40], flank), ("apart", designs[2][:40], designs[4][115:150]),
              ("turned", designs[2][100:140], designs[2][:40]), ("junk", "ACGTACGTAA" * 4, "GGTTGGTTAA" * 4)]
    rows = [(n, "t", a, b) for n, a, b in pairs] + [("half", "t", designs[2][:40], None), ("none", "t", None, None), ("short", "t", "", "")]
    df = spark.createDataFrame(rows, "read_id string, tag string, seq string, mate_seq string")
    lib = spark.createDataFrame([(d, f"d{d}", s) for d, s in designs.items()], "design_idx bigint, name string, sequence string")
    want = plain_pairs(pairs, designs, 800)
    assert {"far", "apart", "turned", "junk"}.isdisjoint(want) and not want["tie"][2]
    got = align_pairs(df, lib).collect()
    together = {}
    for r in got:
        if r.flag & 2:
            together.setdefault(r.read_id, []).append(r)
    assert {n: (sum(r.score for r in x), int(x[0].ref[1:]), x[0].mapq == 42) for n, x in together.items()} == want
    assert all(sorted(r.flag for r in x) == [67, 131] and x[0].ref == x[1].ref and x[0].insert_size <= 800 for x in together.values())
    alone = {(r.read_id, r.flag): r.ref for r in got if not r.flag & 2}
    assert alone[("far", 65)] == "d9" and alone[("apart", 65)] == "d2" and alone[("apart", 129)] == "d4" and alone[("half", 65)] == "d2"
    assert not {n for n, _ in alone} & set(together) and not {n for n, _ in alone} & {"none", "junk"}
    # nothing but fitting pairs without mixed; the other strand; no rows
    turned = df.select("read_id", "tag", F.reverse(F.translate("mate_seq", "ACGT", "TGCA")).alias("seq"), F.reverse(F.translate("seq", "ACGT", "TGCA")).alias("mate_seq"))
    back = align_pairs(turned, lib, mixed=False, strands=("-",)).collect()
    assert {r.read_id for r in back} == set(want) and {r.flag for r in back} == {83, 147}
    assert {(r.read_id, r.pos, r.ref, r.score) for r in back} == {(r.read_id, r.pos, r.ref, r.score) for x in together.values() for r in x}
    assert align_pairs(df.limit(0), lib).count() == 0


def test_every_read_within_the_edit_limit_is_found(spark):
    rng = random.Random(2)
    flank5, flank3 = rand_seq(rng, 26), rand_seq(rng, 20)
    designs = [(i + 1, f"d{i}", flank5 + rand_seq(rng, 50) + flank3) for i in range(60)]
    lib = spark.createDataFrame(designs, "design_idx bigint, name string, sequence string")
    reads, truth = [], {}
    for n in range(150):
        d = designs[0] if n % 3 == 0 else rng.choice(designs)  # one design has a third of the reads
        s = list(d[2])
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(5, len(s) - 5)
            kind = rng.random()
            if kind < 0.6:
                s[i] = rng.choice("ACGT")
            elif kind < 0.8:
                s.pop(i)
            else:
                s.insert(i, rng.choice("ACGT"))
        reads.append((f"r{n}", "t", "".join(s)))
        truth[f"r{n}"] = (d[1], slow_score("".join(s), d[2]))
    df = spark.createDataFrame(reads, "read_id string, tag string, seq string")
    got = {r.read_id: r for r in align_reads(df, lib, max_edits=6, k=9).collect()}
    assert set(got) == set(truth)
    for k, (ref, score) in truth.items():
        assert got[k].ref == ref and got[k].score >= score


def best_places(read, designs):
    """Score and the designs that have it, by the full comparison with every design."""
    scores = [x[0] for x in _glocal([read] * len(designs), [d[2] for d in designs])]
    return max(scores), [d[1] for d, x in zip(designs, scores) if x == max(scores)]


@pytest.mark.parametrize("strands, letters", [(("+",), 1 << 20), (("+", "-"), 0)])
def test_every_read_within_the_score_limit_is_found(spark, strands, letters):
    rng = random.Random(12)
    designs = [(i + 1, f"d{i}", "GGAACGACTCGAG" + rand_seq(rng, 70) + "AAAGAAACAACAAC") for i in range(40)]
    designs += [(41, "twin", designs[3][2]), (42, "short", rand_seq(rng, 15))]
    reads = []
    for n in range(400):
        d = rng.choice(designs)
        size = rng.choice([8, 9, 10, 11, 12, 15, 20, 40, 80])
        at = rng.randrange(max(1, len(d[2]) - size))
        s = list(d[2][at : at + size])
        for _ in range(rng.randint(0, max(1, len(s) // 6))):
            kind, i = rng.random(), rng.randrange(len(s))
            if kind < 0.7:
                s[i] = rng.choice("ACGTN")
            elif kind < 0.85:
                del s[i : i + rng.randint(1, 4)]
            else:
                s[i:i] = rand_seq(rng, rng.randint(1, 4))
            s = s or ["A"]
        s = "".join(s)
        reads.append((f"r{n}", "t", rc(s) if "-" in strands and n % 2 else s))
    reads += [(f"junk{n}", "t", rand_seq(rng, 60)) for n in range(10)] + [("empty", "t", ""), ("none", "t", None)]
    library = spark.createDataFrame(designs, "design_idx bigint, name string, sequence string")
    df = spark.createDataFrame(reads, "read_id string, tag string, seq string")
    got = {r.read_id: r for r in align_reads(df, library, strands=strands, broadcast_letters=letters).collect()}
    found = 0
    for read_id, _, s in reads:
        both = [s, rc(s)] if s and "-" in strands else [s]
        places = [best_places(x, designs) for x in both if x]
        score = max((x for x, _ in places), default=-1000)
        names = [name for x, some in places if x == score for name in some]
        if -score > worst_penalty(len(s or "")):
            assert read_id not in got
            continue
        found += 1
        row = got[read_id]
        assert row.score == score and row.ref in names
        if len(both) == 1:
            assert row.ref == names[0] and row.mapq == (42 if len(names) == 1 else 0)
    assert found >= 300


def test_whole_comparison_shuffles_no_block_again(spark, monkeypatch):
    """Small blocks, several rounds of designs and a twin: the results are brute force's, and little is shuffled."""
    import time

    rng = random.Random(31)
    monkeypatch.setattr("foldmark.operators.align.BROADCAST_LETTERS", 4_000)
    designs = [(i + 1, f"d{i}", rand_seq(rng, rng.choice([60, 90, 250]))) for i in range(60)]
    designs += [(61, "twin", designs[3][2]), (62, "empty", ""), (63, "none", None)]
    reads = []
    for n in range(240):
        s = list(designs[3 if n % 10 == 0 else rng.randrange(60)][2][:50])
        for _ in range(rng.randint(0, 3)):
            s[rng.randrange(50)] = rng.choice("ACGT")
        reads.append(("".join(s), 30))
    reads = [(s, most) for s, most in dict(reads).items()] + [("A" * 50, 3)]
    lib = spark.createDataFrame(designs, "design_idx bigint, ref string, sequence string")
    store = spark.sparkContext._jsc.sc().statusStore()
    before = store.executorSummary("driver").totalShuffleWrite()
    got = {r.seq: r for r in scan_library(spark.createDataFrame(reads, "seq string, limit int"), lib, 250, 16).collect()}
    time.sleep(2)
    assert store.executorSummary("driver").totalShuffleWrite() - before < 300_000
    real = [d for d in designs if d[2]]
    for s, _ in reads[:-1]:
        score, names = best_places(s, real)
        ids = [d[0] for d in real if d[1] in names]
        assert (got[s].score, got[s].ref, got[s].d0, got[s].d1) == (score, names[0], ids[0], ids[-1])
    assert reads[-1][0] not in got


def odd_library(rng, n):
    """Designs full of repeats, and near copies of each other."""
    parts = [rand_seq(rng, 33), "AC" * 40, "A" * 50, rand_seq(rng, 90)]
    designs = []
    for _ in range(n):
        s = list("".join(rng.choices(parts, k=rng.randint(1, 4))) + rand_seq(rng, rng.randint(0, 9)))
        for _ in range(rng.randint(0, 3)):
            s[rng.randrange(len(s))] = rng.choice("ACGTN")
        designs.append("".join(s))
    return designs


def nearly(rng, designs, size):
    """A stretch of a design with an edit or two."""
    s = rng.choice([d for d in designs if len(d) > size])
    at = rng.randrange(len(s) - size)
    read = list(s[at : at + size].replace("N", "G"))
    i, j = rng.sample(range(size - 1), 2)
    kind = rng.randrange(5)
    if kind == 0:
        del read[i]
    elif kind == 1:
        read.insert(i, rng.choice("ACGT"))
    elif kind >= 2:
        for x in (i, j)[: kind - 2]:
            read[x] = rng.choice("ACGT".replace(read[x], ""))
    return "".join(read)


def spelled(read, design, pos, cigar):
    """Penalty and edits of an alignment, letter by letter."""
    i, j, penalty, edits = 0, pos - 1, 0, 0
    for size, op in re.findall(r"(\d+)([MID])", cigar):
        size = int(size)
        if op == "M":
            assert j + size <= len(design)
            wrong = sum(a != b for a, b in zip(read[i : i + size], design[j : j + size]))
            penalty, edits = penalty + 3 * wrong, edits + wrong
        else:
            penalty, edits = penalty + 5 + size, edits + size
        i, j = i + size * (op != "D"), j + size * (op != "I")
    assert i == len(read)
    return penalty, edits


@pytest.mark.parametrize("many, strands", [(64, ("+",)), (1, ("+", "-"))])
def test_near_reads_need_no_whole_comparison(spark, monkeypatch, many, strands):
    """Reads of what very many designs share, by brute force: best score, whether one design alone has it, and the first."""
    rng = random.Random(many)
    monkeypatch.setattr(near, "MANY", many)
    designs = odd_library(rng, 50)
    reads = [nearly(rng, designs, rng.choice([40, 59, 60, 61, 75])) for _ in range(120)] + ["A", "AC", "ACACACA", "A" * 45]
    if many == 1:
        # Patched places don't reach the workers, so the chunk is looked through here.
        p = near.Places(np.arange(50) + 1, [f"d{i}" for i in range(50)], designs, 100)
        for read in {r for r in reads if len(r) > 30 and not any(r in d for d in designs)}:
            scores = [-s for s, *_ in _glocal([read] * 50, designs)]
            penalty, first, last = (x[0] for x in p.near(near._CODE[np.frombuffer(read.encode(), np.uint8)][None]))
            if min(scores) > 6:
                assert last < 0
            else:
                fit = [i for i, s in enumerate(scores) if s == min(scores)]
                assert (penalty, p.design[first // 4 - 1], p.design[last - 1]) == (min(scores), fit[0], fit[-1])
    for module, name in ((align, "scan_library"), (align, "_candidates")):
        monkeypatch.setattr(module, name, lambda *a, **b: pytest.fail("these reads are near"))
    either = {"+": lambda r: r, "-": rc}
    best = {}
    for i, read in enumerate(reads):
        found = [(-s, d + 1, side) for side in strands for d, (s, *_) in enumerate(_glocal([either[side](read)] * 50, designs))]
        if min(found)[0] <= min(6, worst_penalty(len(read))):
            best[f"r{i}"] = [(d, side) for s, d, side in sorted(found) if s == min(found)[0]], min(found)[0]
    assert len(best) > 100
    library = spark.createDataFrame([(i + 1, f"d{i}", s) for i, s in enumerate(designs)], "design_idx bigint, name string, sequence string")
    rows_ = [(f"r{i}", "t", r) for i, r in enumerate(reads) if f"r{i}" in best]
    got = align_reads(spark.createDataFrame(rows_, "read_id string, tag string, seq string"), library, strands=strands).collect()
    assert len(got) == len(best)
    for r in got:
        fit, penalty = best[r.read_id]
        assert -r.score == penalty and r.mapq == (42 if len({d for d, _ in fit}) == 1 else 0)
        assert (int(r.ref[1:]) + 1, "-" if r.flag == 16 else "+") == min(fit)
        assert spelled(r.seq, designs[int(r.ref[1:])], r.pos, r.cigar) == (penalty, r.nm)


def test_exact_pairs_are_sought_at_all_places(spark):
    """A pair stands together only where neither mate stands first, and beside copies that are too far apart."""
    rng = random.Random(5)
    a, b = rand_seq(rng, 60), rand_seq(rng, 70)
    gap = lambda n: rand_seq(rng, n)
    designs = [a + gap(900) + b, b + gap(100) + a, a + gap(1000) + b + gap(900) + a + gap(30) + b, gap(20) + a + b]
    library = spark.createDataFrame([(i + 1, f"d{i}", s) for i, s in enumerate(designs)], "design_idx bigint, name string, sequence string")
    pairs = spark.createDataFrame([("p", "t", a, b), ("q", "t", rc(b), rc(a)), ("s", "t", a, a)], "read_id string, tag string, seq string, mate_seq string")
    got = {(r.read_id, r.flag): tuple(r)[3:7] + (r.score, r.insert_size) for r in align_pairs(pairs, library, strands=("+", "-")).collect()}
    at = 60 + 1000 + 70 + 900 + 1
    assert got[("p", 67)] == ("d2", at, 0, "60M", 0, 160) and got[("p", 131)] == ("d2", at + 90, 0, "70M", 0, 160)
    assert got[("q", 83)] == ("d2", at + 90, 0, "70M", 0, 160) and got[("q", 147)] == ("d2", at, 0, "60M", 0, 160)
    assert got[("s", 67)][:2] == ("d0", 1) and got[("s", 131)][5] == 60


def test_shared_ends_are_no_seeds(spark):
    rng = random.Random(5)
    designs = [(i + 1, f"d{i}", "GGGAACGACTCGAGTAGAGTCGAAAA" + rand_seq(rng, 69) + "AAAGAAACAACAACAACAAC") for i in range(2_000)]
    library = spark.createDataFrame(designs, "design_idx bigint, name string, sequence string")
    reads = spark.createDataFrame([(f"r{n}", rng.choice(designs)[2]) for n in range(100)], "read_id string, seq string")
    seeds = seed_candidates(reads, build_index(library, 12), 2_000, 12, ("+",)).collect()
    assert sum(len({p.design_idx for p in r.places}) for r in seeds) < 150 and all(4 <= r.usable <= 7 for r in seeds)


def test_merge_pairs_with_errors(spark):
    rng = random.Random(4)
    r1, r2, want = [], [], {}
    for n in range(40):
        frag = rand_seq(rng, 100)
        a, b = frag[:60], frag[-60:]
        i = rng.randrange(45, 60)
        a_bad = a[:i] + rng.choice([c for c in "ACGT" if c != a[i]]) + a[i + 1:]
        qa = "I" * i + "#" + "I" * (59 - i)
        r1.append((f"r{n}", a_bad, qa))
        r2.append((f"r{n}", rc(b), "I" * 60))
        want[f"r{n}"] = frag
    r1.append(("far", rand_seq(rng, 60), "I" * 60))
    r2.append(("far", rand_seq(rng, 60), "I" * 60))
    schema = "read_id string, seq string, qual string"
    got = {r.read_id: r for r in merge_pairs(spark.createDataFrame(r1, schema), spark.createDataFrame(r2, schema)).collect()}
    assert not got["far"].merged and got["far"].mate_seq is not None
    for k, frag in want.items():
        assert got[k].merged and got[k].seq == frag and len(got[k].qual) == 100


def test_reads_to_counts_end_to_end(spark):
    rng = random.Random(8)
    lib = [(i + 1, f"d{i}", rand_seq(rng, 80)) for i in range(5)]
    codes = [("treated", "ACGTACGTACGT"), ("control", "TTGCATTGCATG")]
    pairs1, pairs2, n = [], [], 0
    for d in lib:
        for tag, code in codes:
            s = d[2]
            if tag == "treated":
                s = s[:39] + ("A" if s[39] != "A" else "C") + s[40:]
            for _ in range(3):
                insert = code + rc(s)
                pairs1.append((f"r{n}", insert[:60], "I" * 60))
                pairs2.append((f"r{n}", rc(insert[-60:]), "I" * 60))
                n += 1
    # Mates too short to meet: the second one covers the design's first 40 positions.
    insert = codes[1][1] + rc(lib[0][2])
    pairs1.append(("apart", insert[:40], "I" * 40))
    pairs2.append(("apart", rc(insert[-40:]), "I" * 40))
    # A read of two designs alike counts for neither.
    lib += [(6, "twin1", rand_seq(rng, 80))]
    lib += [(7, "twin2", lib[5][2])]
    insert = codes[0][1] + rc(lib[5][2])
    pairs1.append(("twin", insert[:60], "I" * 60))
    pairs2.append(("twin", rc(insert[-60:]), "I" * 60))
    schema = "read_id string, seq string, qual string"
    library = spark.createDataFrame(lib, "design_idx bigint, name string, sequence string")
    out = reads_to_counts(spark.createDataFrame(pairs1, schema), spark.createDataFrame(pairs2, schema), library, codes).collect()
    cov = {(r.design_idx, r.tag): r.n for r in out if r.measure == "coverage" and r.pos == 40}
    assert cov == {(d[0], t): 3 + ((d[0], t) == (1, "control")) for d in lib[:5] for t, _ in codes}
    muts = {(r.design_idx, r.pos, r.tag): r.n for r in out if r.measure != "coverage"}
    assert muts == {(d[0], 40, "treated"): 3 for d in lib[:5]}


def test_fasta_oddities(spark, tmp_path):
    p = tmp_path / "x.fa"
    p.write_text("junk\n\n>1\tt%23\ta b\nACG\nTT\n\n>two words\n\n>3\ng c\n")
    got = [tuple(r) for r in fasta.read_fasta(spark, str(p)).drop("file").orderBy("design_idx").collect()]
    assert got == [(1, "1\tt%23\ta b", "ACGTT"), (2, "two words", ""), (3, "3", "gc")]
    gz = tmp_path / "y.fa.gz"
    with gzip.open(gz, "wt") as f:
        f.write(">a\nAC\n>b\nGG\n")
    assert [r.header for r in fasta.read_fasta(spark, str(gz)).orderBy("design_idx").collect()] == ["a", "b"]


def test_fasta_ordinals_across_splits(spark, tmp_path):
    p = tmp_path / "big.fa"
    p.write_text("".join(f">h{i}\n{'ACGT' * 20}\n" for i in range(4000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = fasta.read_fasta(spark, str(p))
        got = [(r.design_idx, r.header) for r in df.orderBy("design_idx").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [(i + 1, f"h{i}") for i in range(4000)]


def test_barcode_names_have_no_space(spark, tmp_path):
    p = tmp_path / "b.fa"
    p.write_text(">good\nACGT\n>not good\nTTTT\n")
    with pytest.raises(Exception, match="space in barcode name"):
        fasta.read_barcodes(spark, str(p)).collect()


def test_counts_folder_by_file_name(spark, tmp_path):
    (tmp_path / "raw_counts").mkdir()
    with gzip.open(tmp_path / "T1.muts.txt.gz", "wt") as f:
        f.write("0,2,0\n1,0,0\n")
    (tmp_path / "T1.coverage.txt").write_text("5 6 7\n8 9 10\n")
    (tmp_path / "T2.muts.txt").write_text("")
    (tmp_path / "raw_counts" / "T1.GA.txt").write_text("0,1,0\n0,0,0\n")
    df = C.read_counts_dir(spark, str(tmp_path))
    got = sorted(tuple(r) for r in df.select("design_idx", "pos", "tag", "measure", "n").collect())
    want = [(1, 2, "T1", "muts", 2), (2, 1, "T1", "muts", 1), (1, 2, "T1", "GA", 1)]
    want += [(d, p, "T1", "coverage", 5 + (d - 1) * 3 + p - 1) for d in (1, 2) for p in (1, 2, 3)]
    assert got == sorted(want)
    assert C.read_counts_dir(spark, str(tmp_path), raw_counts=False, first=2, last=2).count() == 4


@pytest.mark.parametrize("odd", [None, "blank", "return", "cut", "open"])
def test_count_blocks_are_read_whole(spark, tmp_path, odd):
    """No line is shuffled where blank lines only end blocks; other files give what line after line says."""
    text = [f"d{i}/A/GA\n{'' if odd == 'blank' and i % 3 == 0 else 'ACGU'}\n0,{i},2\n{i},5,6\n\n" for i in range(40)]
    whole = "".join(text[:-1]) + (text[-1].rstrip("\n") if odd == "open" else text[-1])
    at = len("".join(text[:20])) + (9 if odd == "cut" else 0)
    folder = tmp_path / "blocks"
    folder.mkdir()
    for i, part in enumerate((whole[:at], whole[at:])):
        (folder / f"part-{i}").write_bytes((part.replace("\n", "\r\n") if odd == "return" else part).encode())
    got = tables.read_count_blocks(spark, str(folder))
    want = [(i + 1, f"d{i}/A/GA", text[i].split("\n")[1], [0, i, 2], [i, 5, 6]) for i in range(40)]
    assert sorted(tuple(r) for r in got.collect()) == want
    assert (("Aggregate" in got._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]) == (odd is not None))


def test_raw_blocks_assert_their_order(spark, tmp_path):
    from foldmark.fixed_values import MUT_TYPES
    lines = ["d1"] + [f"{t} 0,1" for t in MUT_TYPES] + [""]
    (tmp_path / "ok.txt").write_text("\n".join(lines) + "\n")
    assert tables.read_raw_count_blocks(spark, str(tmp_path / "ok.txt")).count() == 14
    lines[1], lines[2] = lines[2], lines[1]
    (tmp_path / "bad.txt").write_text("\n".join(lines) + "\n")
    with pytest.raises(Exception, match="unexpected mutation type"):
        tables.read_raw_count_blocks(spark, str(tmp_path / "bad.txt")).collect()


def test_fastq_tag_of_file(spark):
    df = spark.createDataFrame([("/x/A_1.fastq.gz",), ("/x/B.fq",)], "file string")
    assert [r[0] for r in df.select(fastq.tag_of_file()).collect()] == ["A_1", "B"]


def test_log_lines_of_each_tool(spark):
    run = "/data/run"
    lines = [
        (f"{run}/0_merge_pairs.err", "Pairs:               \t5000"),
        (f"{run}/0_merge_pairs.err", "Joined:              \t4000   \t80.000%"),
        (f"{run}/1_demux/a.log", "2000-01-01 00:00:00,000 INFO     Demultiplexing complete! 4000 reads processed in 1.0 seconds"),
        (f"{run}/1_demux/a.log", "2000-01-01 00:00:00,000 INFO     3000 (75.0%) reads correctly assigned to sample files"),
        (f"{run}/2_align/T/bowtie2.err", "1500 reads; of these:"),
        (f"{run}/2_align/T/bowtie2.err", "    600 (40.00%) aligned exactly 1 time"),
        (f"{run}/2_align/T/bowtie2.err", "    750 (50.00%) aligned >1 times"),
        (f"{run}/3_count/T.out", '  [*] Sample "x": 12 transcripts covered [A: 3.00; C: 4.00] - 700/1300 (53.85%) mutated alignments'),
    ]
    df = tables.log_stages(spark.createDataFrame(lines, "file string, value string"))
    got = {r.stage: r.n_reads for r in df.collect()}
    assert got == {"into_merge": 5000, "merged": 4000, "into_demux": 4000, "demultiplexed": 3000,
                   "into_align": 1500, "aligned": 1350, "into_count": 1300, "counted": 700}


def test_tiles_are_cut_by_many_tasks(spark):
    """Few bytes become most of the work, so the tasks that cut reads aren't coalesced."""
    from pyspark.sql import functions as F
    from foldmark.queries.reads import _tiles

    tiles = _tiles(spark, "/root/testdata/sf0.001")
    assert tiles.columns == ["design_idx", "dna", "k", "start", "seq"]
    assert tiles.select(F.spark_partition_id().alias("part")).distinct().count() == 4
