"""Fixed values that results depend on.

These are data, not design: changing any of them changes the numbers or the
files a user gets.
"""

# Mutation types of the raw counts, in file order.
MUT_TYPES = (
    "AC", "AG", "AT", "CA", "CG", "CT", "GA", "GC", "GT", "TA", "TC", "TG",
    "ins", "del",
)
MISMATCHES = MUT_TYPES[:12]

# Measures a long counts table may hold besides the mutation types.
COVERAGE = "coverage"
MUTS = "muts"

# Separated reactivity tracks: mutations into one nucleotide, then indels.
TRACKS = {
    "to_A": ("CA", "GA", "TA"),
    "to_C": ("AC", "GC", "TC"),
    "to_G": ("AG", "CG", "TG"),
    "to_T": ("AT", "CT", "GT"),
    "del": ("del",),
    "ins": ("ins",),
}

# Constant ends recognised by automatic end blanking: (sequence, positions).
FIVE_PRIME_ENDS = (
    ("GGGAACGACUCGAGUAGAGUCGAAAA", 26),
    ("UUCUAAUACGACUCACUAUAGGGAACGACUCGAGUAGAGUCGAAAA", 46),
)
THREE_PRIME_ENDS = (("AAAGAAACAACAACAACAAC", 20),)

T7_PROMOTER = "TTCTAATACGACTCACTATA"

# Letters allowed in a sequence library.
SEQUENCE_ALPHABET = "ACGTUN"

# Adapters of the demultiplexing and trimming stages.
DEMUX_ADAPTER = "AGATCGGAAGAGCGGTTCAG"
ULTIMA_ADAPTER = "AGATCGGAAGAGCACA"
ULTIMA_BARCODE_PREFIX = "CTACACGACGCTCTTCCGATCT"
LONG_READ_3PRIME_ADAPTER = "AGATCGGAAGAGCGGTTCAGCAGGAATGCCGAGACCGATCTCGTATGCCGTCTTCTGCTTG"
LONG_READ_5PRIME_ADAPTER = "AATGATACGGCGACCACCGAGATCTACACTCTTTCCCTACACGACGCTCTTCCGATCT"

# Coverage cutoffs tried, in turn, for the normalization set.
NORM_CUTOFFS = (10000, 1000, 100)
NORM_MIN_HITS = 10
NORM_MAX_SEQUENCES = 1000
