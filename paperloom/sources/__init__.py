"""Raw files, normalized relations and their merge."""
