"""Defaults of a run."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TopicConfig:
    """Parameters of a run. The values are fixed defaults, every one can be replaced."""

    # corpus assembly
    categories: tuple[str, ...] = ("cs.AI", "cs.LG", "cs.CV", "cs.CL", "cs.NE", "cs.RO", "stat.ML")
    min_year: int = 2018
    max_results: int = 5000
    max_results_per_category: int = 2000

    # text and features
    min_word_length: int = 2
    max_word_length: int = 30
    max_features: int = 10_000
    bow_max_terms: int = 100_000
    ngram_range: tuple[int, int] = (1, 1)
    min_df: int = 2
    max_df: float = 0.95
    weighting: str = "tfidf"

    # methods
    methods: tuple[str, ...] = ("lda", "nmf", "clusters")

    # LDA
    lda_topics: tuple[int, ...] = (3, 5, 7, 10)
    lda_topic_prior: float = 0.01
    lda_passes: int = 20
    #: Share of the documents that one update of the online fit samples, at every size.
    lda_batch_share: float = 1.0
    lda_restarts: int = 1
    coherence: str = "c_v"

    # NMF
    nmf_topics: tuple[int, ...] = (5, 8, 10, 12, 15, 18, 20)
    nmf_alpha: float = 0.0
    nmf_l1_ratio: float = 0.5
    nmf_max_iter: int = 200

    # embedding clusters
    cluster_topics: tuple[int, ...] = (3, 5, 7, 10)
    min_topic_size: int = 10
    embedding_dims: int = 64
    reduced_dims: int = 5

    seed: int = 42

    # evaluation
    min_category_count: int = 50
    top_categories: int = 10
    words_per_topic: int = 15
    coherence_words: int = 20
    categories_per_topic: int = 10

    def middle(self, topics: tuple[int, ...]) -> int:
        """Topic count used when no sweep is wanted."""
        return topics[len(topics) // 2]
