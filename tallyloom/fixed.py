"""Fixed values. They must stay as they are for results to be right."""

# Input documents.
DIALECT = "alphafold3"
SINGLE_VERSION = 2
SINGLE_CHAIN = "A"
SINGLE_SEEDS = [4]
COMPOSED_VERSION = 2
COMPOSED_SEEDS = [1]

# Composed records letter their members B, C, ... Z, AA, AB, ...
FIRST_COMPOSED_LETTER = "B"
MEMBER_DELIMITER = "_"

# Half-open size windows: lo < size <= hi.
BATCH_WINDOW = (16, 6000)
COMPLEX_WINDOW = (16, 2500)

# Seconds of one prediction as a polynomial in its size: c2, c1, c0.
COST_SECONDS = (1.44451398e-04, -1.18261348e-01, 5.38503478e01)
BATCH_HOURS = 3
MAX_SPLITS = 200
# Ids in one list of batch members.
MEMBER_CHUNK = 10_000

# Weights of the two interface scores in the model confidence.
CONFIDENCE_IPTM = 0.8
CONFIDENCE_PTM = 0.2

# White space trimmed off raw names.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Ids allowed in paths.
ID_PATTERN = r"(?U)^[\w.-]*$"

# Whole log lines, with the captured value as the only group.
LOG_SIZE = r"^\S+ \S+ \S+ \S+ Calculating bucket size for input with ([-+]?[0-9]+) tokens\.$"
LOG_RUNTIME = (
    r"^Running model inference and extracting output structures for seeds \(4,\) took "
    r"([-+]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][-+]?[0-9]+)?) seconds\.$"
)
LOG_DONE = r"^Done processing fold input (\S+)\.$"
# Words that lines of these forms contain.
LOG_WORDS = [
    "Calculating bucket size for input with",
    "Running model inference and extracting output structures",
    "Done processing fold input",
]
WALL_CLOCK_MARKER = "Wall-clock"

# Resources by total size; bounds are inclusive integers, None is open.
TIERS_A = [
    {"lo": 0, "hi": 199, "runtime": "04:00", "gpu_mem": "10240",
     "cpu_mem_mb": 240000, "scratch_mb": 120000, "unified_memory": 0, "mem_fraction": 1},
    {"lo": 200, "hi": 1499, "runtime": "24:00", "gpu_mem": "20240",
     "cpu_mem_mb": 240000, "scratch_mb": 120000, "unified_memory": 1, "mem_fraction": 2},
    {"lo": 1500, "hi": 2499, "runtime": "24:00", "gpu_mem": "40000",
     "cpu_mem_mb": 240000, "scratch_mb": 240000, "unified_memory": 1, "mem_fraction": 4},
    {"lo": 2500, "hi": 3499, "runtime": "48:00", "gpu_mem": "80000",
     "cpu_mem_mb": 240000, "scratch_mb": 240000, "unified_memory": 1, "mem_fraction": 4},
    {"lo": 3500, "hi": None, "runtime": "120:00", "gpu_mem": "80000",
     "cpu_mem_mb": 240000, "scratch_mb": 320000, "unified_memory": 1, "mem_fraction": 8},
]
TIERS_B = [
    {"kind": "monomer", "lo": 0, "hi": 500, "runtime": "04:00:00", "gpu_mem": "11g"},
    {"kind": "monomer", "lo": 501, "hi": 2500, "runtime": "24:00:00", "gpu_mem": "24g"},
    {"kind": "monomer", "lo": 2501, "hi": None, "runtime": "48:00:00", "gpu_mem": "40g"},
    {"kind": "multimer", "lo": 1000, "hi": 2500, "runtime": "48:00:00", "gpu_mem": "24g"},
    {"kind": "multimer", "lo": 2501, "hi": None, "runtime": "120:00:00", "gpu_mem": "80g"},
]

# Resources by attempt, one ladder per step.
LADDERS = {
    "pipeline": {
        "runtime": ["4h", "1d", "3d", "1w"],
        "mem_mb": [65536, 131072, 262144, 262144],
        "disk_mb": [65536, 131072, 262144, 262144],
        "gpu_mem": [None, None, None, None],
    },
    "prediction": {
        "runtime": ["3d", "3d", "3d", "3d", "3d"],
        "mem_mb": [49152, 65536, 65536, 65536, 98304],
        "disk_mb": [49152, 65536, 65536, 65536, 98304],
        "gpu_mem": ["11g", "24g", "32g", "40g", "80g"],
    },
    "multimer": {
        "runtime": ["4h", "4h", "4h"],
        "mem_mb": [65536, 65536, 65536],
        "disk_mb": [65536, 65536, 65536],
        "gpu_mem": ["32g", "40g", "80g"],
    },
}

# Hardware variants compared on one input.
VARIANTS = [
    "rtx_2080_ti", "rtx_3090", "rtx_4090", "titan_rtx",
    "quadro_rtx_6000", "v100", "a100_pcie_40gb", "a100_80gb",
]
