"""Schemas and fixed values of the data model."""

#: The structural alphabet, and letters that amino-acid input may hold for unknowns.
ALPHABET = "ACDEFGHIKLMNPQRSTVWY"
RARE_RESIDUES = "UZOB"
#: Parameters that results depend on.
EVALUE_CEILING = 10.0
EVALUE_FLOOR = 1e-300
EVALUE_THRESHOLDS = (1e-50, 1e-30, 1e-10, 1e-5, 1e-3, 0.01, 0.1, 1.0)
IDENTITY_BUCKETS = ((0.9, 1.0), (0.7, 0.9), (0.5, 0.7), (0.3, 0.5), (0.0, 0.3))
KMER = 3
SMOOTHING_WINDOW = 10
ENTROPY_THRESHOLD = 1.0
MIN_BLOCK_LENGTH = 5
MAX_GAP_FRACTION = 0.5
CLUSTERS = 8
LAST_MERGES = 30
SAMPLE = {"composition": 200, "distance": 50, "reduction": 2000}

#: The columns of the files that are read and written.
HITS = "query string, target string, fident double, alnlen int, mismatch int, gapopen int, qstart int, qend int, tstart int, tend int, evalue double, bits double"
METADATA = "accession_file string, assemblies_requested array<string>, assemblies_downloaded array<string>, num_sequences long, three_di_fasta string, search_results string, _corrupt string"
REPORT_PAGE = "reports array<struct<accession: string>>, next_page_token string"
BENCHMARK = "accession string, num_proteins long, total_residues long, threads int, split_length int, rep int, time_createdb_s double, time_search_s double, time_total_s double"
