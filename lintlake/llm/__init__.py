"""Operations of a training-data pipeline: language ID, sharding, tokens, packing, quality, HTML, near duplicates, chat."""
