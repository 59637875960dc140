"""Part of loopweaver."""
