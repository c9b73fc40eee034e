"""Constants and lookup rows the results must agree with."""

# Defaults of a missing measurement or call.
MISSING_TAXON = "N/A"
MISSING_CALL = "NA"
UNKNOWN_SPECIES = "Unknown"
NO_DATABASE = "none"

# Rank codes kept from a classification report, and their written names.
RANK_NAMES = {"G": "Genus", "S": "Species", "U": "Unclassified"}
# Hits kept per rank.
HITS_PER_RANK = 3
UNCLASSIFIED_HITS = 1

# Suffixes of the keys in the metrics report.
MATE_SUFFIXES = ("_processed_R1", "_processed_R2")
HIT_KEY_SUFFIXES = (".kraken", "", "_processed")
GENERAL_STATS_INDEX = 2
IGNORED_MODULE = "per_base_sequence_content"

# Trimming, subsampling and capacity parameters.
LEADING_QUALITY = 3
TRAILING_QUALITY = 3
WINDOW_SIZE = 4
WINDOW_QUALITY = 20
MIN_LENGTH = 100
SEED_MISMATCHES = 2
SUBSAMPLE_MIN_PAIRS = 2_000_001
SUBSAMPLE_PAIRS = 2_000_000
SUBSAMPLE_SEED = 100
UTILISATION_TARGET = 0.8
DEPENDENCY_PREVIEW = 3
STAGE_PREVIEW = 5

# Species, taxid, expected genome size in bases. The name is the key.
GENOME_SIZES = [
    ("Acinetobacter baumannii", "470", "3975000"),
    ("Citrobacter freundii", "546", "5250000"),
    ("Enterococcus faecalis", "1351", "2950000"),
    ("Escherichia coli", "562", "5150000"),
    ("Enterobacter cloacae", "550", "5100000"),
    ("Enterobacter cloacae complex", "550", "5100000"),
    ("[Enterobacter] aerogenes", "548", "5600000"),
    ("Klebsiella aerogenes", "548", "5600000"),
    ("Klebsiella oxytoca", "571", "5850000"),
    ("Klebsiella pneumoniae", "573", "5600000"),
    ("Klebsiella quasipneumoniae", "1463165", "5600000"),
    ("Klebsiella variicola", "244366", "5600000"),
    ("Morganella morganii", "582", "4800000"),
    ("Photobacterium leiognathi", "553611", "4741959"),
    ("Pseudomonas aeruginosa group", "136841", "6475000"),
    ("Pseudomonas aeruginosa", "287", "6475000"),
    ("Pseudomonas shirazica", "1940636", "5903125"),
    ("Proteus mirabilis", "584", "4750000"),
    ("Providencia stuartii", "588", "4750000"),
    ("Salmonella enterica", "28901", "5050000"),
    ("Serratia marcescens", "615", "5200000"),
    ("Staphylococcus aureus", "1280", "2800000"),
    ("Staphylococcus xylosus", "1288", "2820205"),
    ("Xanthomonas campestris", "339", "5012521"),
]

# Old species name, new species name.
RENAMES = [("[Enterobacter] aerogenes", "Klebsiella aerogenes")]
