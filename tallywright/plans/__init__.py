"""Named SQL packs and the stage tables they run on."""
