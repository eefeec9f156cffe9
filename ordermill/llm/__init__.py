"""Operations for preparing training data at scale: filters, deduplication, search, audits, mixing."""
