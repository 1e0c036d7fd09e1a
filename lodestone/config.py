"""Sizes, weights and type tables that fix the results of every job."""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values -----------------------------------------------------------

CODE_SOFT_BYTES = 1024
CODE_HARD_BYTES = 2048
NEWLINE_REACH = 2048
CODE_OVERLAP_BYTES = 102

DOC_SOFT_BYTES = 2048
DOC_HARD_BYTES = 4096
DOC_OVERLAP_BYTES = 256
DOC_MIN_BYTES = 512
PARAGRAPH_REACH = 2048
DOC_VERSION = "doc-chunker-v1"

EMBEDDING_DIM = 1024
EMBEDDING_BATCH = 64
QUERY_PREFIX = (
    "Instruct: Given a web search query, retrieve relevant passages that answer the query\nQuery:"
)

DEFAULT_TOP_K = 10
DEFAULT_INITIAL_LIMIT = 100
MAX_INITIAL_LIMIT = 50
CANDIDATE_FACTOR = 5
RERANK_BATCH = 8
RRF_K = 60
VECTOR_WEIGHT = 0.7
KEYWORD_WEIGHT = 0.3
BM25_K1 = 1.2
BM25_B = 0.75
BM25_IDF_FLOOR = 1e-6

CODE_LANGUAGES = {
    "kt": "kotlin", "kts": "kotlin", "java": "java", "dart": "dart", "pas": "pascal",
    "pp": "pascal", "py": "python", "pyi": "python", "js": "javascript", "jsx": "javascript",
    "mjs": "javascript", "ts": "typescript", "tsx": "typescript", "cs": "csharp", "go": "go",
    "rs": "rust", "cpp": "cpp", "cc": "cpp", "cxx": "cpp", "hpp": "cpp", "h": "cpp", "c": "c",
    "php": "php", "rb": "ruby", "swift": "swift",
}

MARKUP_LANGUAGES = {
    "arb": "json", "lock": "yaml", "xml": "xml", "plist": "xml", "entitlements": "xml",
    "storyboard": "xml", "xib": "xml", "svg": "xml", "properties": "properties",
    "pro": "properties", "cfg": "properties", "html": "html", "css": "css",
}

DOCUMENT_FAMILIES = {
    "md": "markdown", "markdown": "markdown", "rst": "markdown",
    "json": "json", "jsonl": "jsonl", "ndjson": "jsonl",
    "yaml": "yaml", "yml": "yaml", "toml": "toml", "csv": "csv", "tsv": "tsv",
}


@dataclass(frozen=True)
class SearchSettings:
    """How many candidates a search considers and how it fuses them."""

    candidate_factor: int = CANDIDATE_FACTOR
    rrf_k: int = RRF_K
    vector_weight: float = VECTOR_WEIGHT
    keyword_weight: float = KEYWORD_WEIGHT

    @staticmethod
    def limit(requested) -> int:
        return max(1, int(requested))

    def candidates(self, requested) -> int:
        return self.limit(requested) * self.candidate_factor


def first_stage_limit(
    top_k: int, initial: int = DEFAULT_INITIAL_LIMIT, ceiling: int = MAX_INITIAL_LIMIT
) -> int:
    """Number of fused candidates handed to the reranker."""
    return max(top_k, min(max(initial, top_k), ceiling))
