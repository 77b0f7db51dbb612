"""Ready-made specs and the loads built from them."""
