"""facetforge: DataFrame programs that select, edit, gate and report pairs over segmented 3D assets."""
