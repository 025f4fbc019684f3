"""Training-data pipeline operators (text cleaning, deduplication, packing, search, archives)."""
