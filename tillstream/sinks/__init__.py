"""Writers of topics and ranking tables."""
