"""Edge readers, edge and rank writers, generated and derived graphs."""
