"""Plan-level building blocks: sessions, materialisation, skew-safe joins, distributed ordering."""
