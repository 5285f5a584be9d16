"""Parameters of the pipeline in one frozen object."""

from __future__ import annotations

from dataclasses import dataclass

TEXT_FIELDS = (
    "headline",
    "attribute",
    "description",
    "symptoms",
    "conditions",
    "workarounds",
    "release_note",
)
CATEGORY_FIELDS = ("project", "product", "manager", "severity")
# Order in which category scores are listed in an explanation.
EXPLAIN_FEATURES = ("pin", "manager", "product", "project", "severity")


@dataclass(frozen=True)
class Config:
    """Defaults follow the documented workload; every value can be changed.

    ``compat`` turns on the historical quirks that the default behaviour fixes:
    fields glued without a separator (ids and known duplicates included), and
    category values looked up word by word.
    """

    vector_size: int = 300
    window_size: int = 3
    min_count: int = 1
    word2vec_iterations: int = 10
    # Words more frequent than this share of all words are thinned out in training, 0 keeps all.
    word2vec_sample: float = 0.0
    # Partitions for training word vectors; None takes the session's parallelism.
    word2vec_partitions: int | None = None
    pca_components: int = 100
    members_per_cluster: int = 20
    kmeans_iterations: int = 200
    kmeans_inits: int = 30
    # Starts that take their steps to the end; the others are judged on the pool they are drawn from.
    kmeans_starts: int = 3
    kmeans_tolerance: float = 1e-3
    neighbours: int = 20
    min_frequency: int = 2
    seed: int = 42
    compat: bool = False
